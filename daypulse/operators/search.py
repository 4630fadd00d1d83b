"""Search over documents: token match AND exact filter (P13), score sort
with a page of 20 (L1), nested element match, and highlighting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse import params
from daypulse.functions.text import has_token, highlight, token_hits


def search_docs(docs: DataFrame, token: str, lang: str, size: int = params.SEARCH_PAGE_SIZE) -> DataFrame:
    """must(match token) + filter(term lang), sorted by ``n_chars`` desc, id.
    ``orderBy().limit()`` is a top-k per partition plus a merge."""
    return (docs.where((F.col("lang") == lang) & has_token(F.col("text"), token))
            .select("doc_id", "n_chars")
            .orderBy(F.col("n_chars").desc(), F.col("doc_id"))
            .limit(size))


def nested_exists(nested: DataFrame, array_col: str, pred) -> DataFrame:
    """Documents with at least one array element satisfying ``pred`` (for
    data that arrives nested, e.g. a search document with ``actorList``)."""
    return nested.where(F.exists(array_col, pred))


def turns_match(conv: DataFrame, role: str, token: str) -> DataFrame:
    """Conversations that have a turn with ``role`` whose text has ``token``.

    Same answer as ``exists(turns, t -> t.role = role and match(t.text))``
    over the conversation nested as an array, but evaluated on the flat turn
    rows: no group is collected, and the distinct on ``conv_id`` combines
    map-side, so a conversation of any length costs no single task."""
    hit = conv.where((F.col("role") == role) & has_token(F.col("text"), token))
    return hit.select("conv_id").distinct()


def highlighted(docs: DataFrame, token: str, lang: str) -> DataFrame:
    """Every matching document, whole text, with hit count and marked text."""
    m = docs.where((F.col("lang") == lang) & has_token(F.col("text"), token))
    return m.select("doc_id", token_hits(F.col("text"), token).alias("hits"),
                    highlight(F.col("text"), token, params.HIGHLIGHT_PRE, params.HIGHLIGHT_POST).alias("marked"))


def request(turns: DataFrame, token: str, term_role: str, size: int = params.SEARCH_PAGE_SIZE) -> DataFrame:
    """The search page as one request over conversations (documents with nested
    turns): match ``token`` in any turn AND an exact nested term (a turn with
    ``role``), best score first, ``size`` documents, highlighted.

    Score is the number of hits over all turns. Scores combine map-side per
    conversation; only the page's conversations, at most ``size``, go back to
    the turns for their first matching text."""
    hits = token_hits(F.col("text"), token)
    scored = turns.select("conv_id", "role", hits.alias("hits")).groupBy("conv_id").agg(
        F.sum("hits").alias("score"), F.max((F.col("role") == term_role).cast("int")).alias("term"))
    page = (scored.where("score > 0 AND term = 1").select("conv_id", "score")
            .orderBy(F.col("score").desc(), "conv_id").limit(size))
    first = (turns.where(has_token(F.col("text"), token)).join(F.broadcast(page), "conv_id")
             .groupBy("conv_id", "score").agg(F.min(F.struct("turn", "text")).alias("t")))
    marked = highlight(F.col("t.text"), token, params.HIGHLIGHT_PRE, params.HIGHLIGHT_POST)
    return first.select("conv_id", "score", F.col("t.turn").alias("turn"), marked.alias("marked"))
