"""Search group: token match with exact filter and a sorted page, nested
element match, highlighting."""

from __future__ import annotations

from daypulse import params
from daypulse.functions.text import token_class, token_pattern
from daypulse.operators import search as Q
from daypulse.plans.registry import query
from daypulse.sources.tables import read_table


@query("search_docs", f"""
SELECT doc_id, n_chars FROM documents
WHERE lang = '{params.SEARCH_LANG}' AND regexp_matches(text, '{token_pattern(params.SEARCH_TOKEN)}')
ORDER BY n_chars DESC, doc_id LIMIT {params.SEARCH_PAGE_SIZE}
""")
def search_docs(spark, sf_dir):
    return Q.search_docs(read_table(spark, sf_dir, "documents"), params.SEARCH_TOKEN, params.SEARCH_LANG)


@query("search_nested", f"""
SELECT DISTINCT conv_id FROM conversations
WHERE role = '{params.NESTED_ROLE}' AND regexp_matches(text, '{token_pattern(params.NESTED_TOKEN)}')
""")
def search_nested(spark, sf_dir):
    return Q.turns_match(read_table(spark, sf_dir, "conversations"), params.NESTED_ROLE, params.NESTED_TOKEN)


@query("search_hits", f"""
SELECT doc_id,
       CAST(len(list_filter(regexp_split_to_array(text, '[^A-Za-z0-9_]+'),
                            lambda w: lower(w) = '{params.HIGHLIGHT_TOKEN}')) AS BIGINT) AS hits
FROM documents
WHERE lang = '{params.SEARCH_LANG}' AND regexp_matches(text, '{token_pattern(params.HIGHLIGHT_TOKEN)}')
""")
def search_hits(spark, sf_dir):
    """Whole-word hit count per matching document (whole texts)."""
    return Q.highlighted(read_table(spark, sf_dir, "documents"), params.HIGHLIGHT_TOKEN,
                         params.SEARCH_LANG).select("doc_id", "hits")


MARK_SQL = (f"regexp_replace(text, '\\b({token_class(params.HIGHLIGHT_TOKEN)})\\b', "
            f"'{params.HIGHLIGHT_PRE}\\1{params.HIGHLIGHT_POST}', 'g')")
HITS_SQL = ("len(list_filter(regexp_split_to_array(text, '[^A-Za-z0-9_]+'), "
            f"lambda w: lower(w) = '{params.HIGHLIGHT_TOKEN}'))")


@query("search_request", f"""
WITH t AS (SELECT *, {HITS_SQL} AS hits FROM conversations),
s AS (SELECT conv_id, CAST(sum(hits) AS BIGINT) AS score FROM t GROUP BY conv_id
      HAVING sum(hits) > 0 AND bool_or(role = '{params.SEARCH_TERM_ROLE}')
      ORDER BY score DESC, conv_id LIMIT {params.SEARCH_PAGE_SIZE}),
f AS (SELECT t.conv_id, s.score, t.turn, t.text,
        row_number() OVER (PARTITION BY t.conv_id ORDER BY t.turn, t.text) AS rn
      FROM t JOIN s USING (conv_id) WHERE hits > 0)
SELECT conv_id, score, turn, {MARK_SQL} AS marked FROM f WHERE rn = 1
""")
def search_request(spark, sf_dir):
    """Match AND exact nested term, sorted by score, 20, highlighted."""
    return Q.request(read_table(spark, sf_dir, "conversations"), params.SEARCH_TOKEN, params.SEARCH_TERM_ROLE)


@query("search_highlight", f"""
SELECT doc_id, CAST({HITS_SQL} AS BIGINT) AS hits, {MARK_SQL} AS marked
FROM documents
WHERE lang = '{params.SEARCH_LANG}' AND regexp_matches(text, '{token_pattern(params.HIGHLIGHT_TOKEN)}')
""")
def search_highlight(spark, sf_dir):
    """Matching documents, whole text, with every hit wrapped in markers."""
    return Q.highlighted(read_table(spark, sf_dir, "documents"), params.HIGHLIGHT_TOKEN, params.SEARCH_LANG)
