"""Alignment of two tokenizers' tokens over the same bytes."""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import saved
from daypulse.llm.tokens import ByteEncoder, byte_level, tokenizer_path

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters that are aligned at once; a longer text is aligned alone.
BLOCK_CHARS = 1 << 17
#: The sign that stands for a space in B's pieces.
SPACE_SIGN = "▁"


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the pairs that can end
    together. ``A`` reads a space and the text; ``B`` puts that space itself."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = ByteEncoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_level()
        tokens = self.a.tokenizer.get_vocab()
        added = {i: t.content for i, t in self.a.tokenizer.get_added_tokens_decoder().items()}
        self.a_bytes = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.a_bytes[i] = added[i].encode() if i in added else bytes(of[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(SPACE_SIGN, " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self._pairs = self._texts = None

    def encode(self, text: str | None) -> tuple[bytes, bytes] | None:
        """Ids of A and of B as 32-bit integers, None where the text is empty or
        the bytes of either are not a space and the text."""
        if not text:
            return None
        whole = " " + text
        a, b, want = self.a.encode(whole), self.b.encode(text, num_threads=1), whole.encode()
        if b"".join([self.a_bytes[i] for i in a]) != want or b"".join([self.b_bytes[i] for i in b]) != want:
            return None
        return array("i", a).tobytes(), array("i", b).tobytes()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All id pairs that can end together, as sorted numbers, and their B
        ids. Tokens that end together are suffixes one of the other, so the
        vocabularies alone bound them: a pair per suffix that is a token."""
        if self._pairs is None:
            by_bytes: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
            for found, tokens in zip(by_bytes, (self.a_bytes, self.b_bytes)):
                for i, x in enumerate(tokens):
                    found[x].append(i)
            n = len(self.b_bytes)
            numbers = {a * n + b for a, x in enumerate(self.a_bytes) for k in range(len(x))
                       for b in by_bytes[1].get(x[k:], ())}
            numbers |= {a * n + b for b, x in enumerate(self.b_bytes) for k in range(1, len(x))
                        for a in by_bytes[0].get(x[k:], ())}
            pairs = np.array(sorted(numbers), np.int64)
            self._pairs = pairs, pairs % n
        return self._pairs

    def numbered(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each id pair in ``pairs``."""
        return np.searchsorted(self.pairs()[0], a.astype(np.int64) * len(self.b_bytes) + b)

    def texts(self) -> list[np.ndarray]:
        """Decimal ids with the sign that follows: A inside a group, at its end,
        B inside a group, at its end."""
        if self._texts is None:
            self._texts = [np.array([f"{i}{sign}" for i in range(len(tokens))], object)
                           for tokens, signs in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for sign in signs]
        return self._texts


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair of tokenizers per worker process and files."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Tokenizers(path_a, path_b)
    return _loaded[path_a, path_b]


def spans(doc: np.ndarray, sizes: np.ndarray, side: str) -> pd.DataFrame:
    """Tokens in reading order with their document and bytes ``at`` to ``end``.
    Places run on through the documents, so they rise as merge_asof needs."""
    end = np.cumsum(sizes)
    return pd.DataFrame({"doc": doc, "at": end - sizes, f"{side}_end": end, side: np.arange(len(sizes))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of an A and a B token that share bytes: the B token that covers
    each A start, and the A token that covers each B start. Two tokens overlap
    only if one starts inside the other; those that start together are found
    both ways and kept once."""
    cover_a = pd.merge_asof(a, b.assign(b_at=b["at"]), on="at", by="doc")
    cover_b = pd.merge_asof(b, a.assign(a_at=a["at"]), on="at", by="doc")
    cover_b = cover_b[cover_b["a_at"] < cover_b["at"]]
    columns = ["a", "b", "a_end", "b_end"]
    return pd.concat([cover_a[columns], cover_b[columns]], ignore_index=True)


class Aligned:
    """The alignment of a block of texts as flat arrays over all of them: ids
    ``a`` and ``b``, tokens and groups per text, and the last token of each side
    in each group (places in ``a`` and ``b``)."""

    def __init__(self, tok: Tokenizers, texts: list[str | None]):
        encoded = [tok.encode(t) or (b"", b"") for t in texts]
        self.tok = tok
        self.a, self.b = (np.frombuffer(b"".join([e[k] for e in encoded]), np.int32) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(e[k]) // 4 for e in encoded], np.int64) for k in (0, 1))
        doc = np.arange(len(texts))
        doc_a = np.repeat(doc, self.n_a)
        self.overlaps = overlaps(spans(doc_a, tok.a_size[self.a], "a"),
                                 spans(np.repeat(doc, self.n_b), tok.b_size[self.b], "b"))
        met = self.overlaps[self.overlaps["a_end"] == self.overlaps["b_end"]]
        last_b = np.full(len(self.a), -1, np.int64)
        last_b[met["a"].to_numpy()] = met["b"].to_numpy()
        self.a_last = np.flatnonzero(last_b >= 0)
        self.b_last = last_b[self.a_last]
        self.doc_a, self.doc = doc_a, doc_a[self.a_last]
        self.groups = np.bincount(self.doc, minlength=len(texts))

    def lists(self, with_overlaps: bool) -> list[pa.Array]:
        """Columns of ``align`` after doc_id."""
        before_a, before_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        out = [_lists(self.a, self.n_a), _lists(self.b, self.n_b),
               _lists(self.a_last + 1 - before_a[self.doc], self.groups),
               _lists(self.b_last + 1 - before_b[self.doc], self.groups)]
        if with_overlaps:
            both = self.overlaps.sort_values(["a", "b"])
            over_a, over_b = both["a"].to_numpy(), both["b"].to_numpy()
            doc = self.doc_a[over_a]
            counts = np.bincount(doc, minlength=len(self.n_a))
            out += [_lists(over_a - before_a[doc], counts), _lists(over_b - before_b[doc], counts)]
        return out

    def links(self) -> list[bytes]:
        """Each text's links as places in ``Tokenizers.pairs``, 32-bit integers."""
        number = self.tok.numbered(self.a[self.a_last], self.b[self.b_last]).astype("<i4").tobytes()
        ends = (4 * np.cumsum(self.groups)).tolist()
        return [number[s:e] for s, e in zip([0, *ends[:-1]], ends)]

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, empty without tokens: every id's decimal
        text goes to its place among both sides' ids, group by group."""
        a_in, a_end, b_in, b_end = self.tok.texts()
        text = np.empty(len(self.a) + len(self.b), object)
        # A's ids move behind B's of the groups before, B's behind A's of their own too
        a_before, b_before = np.append(0, self.a_last + 1), np.append(0, self.b_last + 1)
        a_at = np.arange(len(self.a)) + np.repeat(b_before[:-1], np.diff(a_before))
        b_at = np.arange(len(self.b)) + np.repeat(a_before[1:], np.diff(b_before))
        text[a_at], text[b_at] = a_in[self.a], b_in[self.b]
        text[a_at[self.a_last]], text[b_at[self.b_last]] = a_end[self.a[self.a_last]], b_end[self.b[self.b_last]]
        text, ends = text.tolist(), np.cumsum(self.n_a + self.n_b).tolist()
        return [hashlib.sha256("".join(text[s:e])[:-1].encode()).hexdigest() if e > s else ""
                for s, e in zip([0, *ends[:-1]], ends)]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of a batch, BLOCK_CHARS at a time."""
    ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
    start, chars = 0, 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= BLOCK_CHARS or k + 1 == len(texts):
            yield ids.slice(start, k + 1 - start), texts[start:k + 1]
            start, chars = k + 1, 0


def align(docs: DataFrame, path_a: str, path_b: str, with_overlaps: bool = False) -> DataFrame:
    """One row per row of ``docs``: the ids of both tokenizers, and for each
    group how many tokens of A (``a_upto``) and of B (``b_upto``) lie before its
    end. A group ends where tokens of both end; the last two of a group are its
    link. ``with_overlaps`` adds the places of all tokens that share bytes
    (``over_a``, ``over_b``).

    Runs on rows as they lie, without a shuffle; a text needs memory in
    proportion to its length. A text that is null, empty, or not given back
    byte for byte by both tokenizers (it holds B's own space sign) has empty
    lists. Null and repeated doc_ids are rows like any other; an empty table
    gives none; other columns are not read."""
    names = ["doc_id", "a_ids", "b_ids", "a_upto", "b_upto"] + ["over_a", "over_b"] * with_overlaps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(path_a, path_b)
        for batch in batches:
            for ids, texts in blocks(batch):
                yield pa.RecordBatch.from_arrays([ids, *Aligned(tok, texts).lists(with_overlaps)], names=names)

    schema = "doc_id bigint, " + ", ".join(f"{c} array<int>" for c in names[1:])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


LINKED_SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """What ``align`` finds in each row, in short: sizes, the digest of its groups
    and its links as numbers of id pairs (``Aligned.links``)."""
    names = [c.split()[0] for c in LINKED_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(path_a, path_b)
        for batch in batches:
            for ids, texts in blocks(batch):
                found = Aligned(tok, texts)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found.n_a), pa.array(found.n_b), pa.array(found.groups),
                     pa.array(found.digests(), pa.string()), pa.array(found.links(), pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, LINKED_SCHEMA)


def pair_counts(rows: DataFrame, n_pairs: int) -> DataFrame:
    """``pair, n``: how many links of the whole corpus are of an id pair. A task
    counts in one array as long as the list of pairs, which the vocabularies
    bound, and sends what is not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_pairs, np.int64)
        for batch in batches:
            links = np.frombuffer(b"".join(batch.column("links").to_pylist()), "<i4")
            counts += np.bincount(links, minlength=n_pairs)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["pair", "n"])

    return (rows.select("links").mapInArrow(run, "pair bigint, n bigint")
            .groupBy("pair").agg(F.sum("n").alias("n")))


SCORED_SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                 "count_sum bigint, groups_sha256 string")


def op13_tokenizer_alignment(spark: SparkSession, docs: DataFrame, path_a: str | None = None,
                             path_b: str | None = None) -> DataFrame:
    """Sizes, links and digest of every document's alignment. A short form of the
    alignments is written once; the pair counts (at most one per pair that the
    vocabularies allow, 324,302 here) come to the driver and go to all tasks."""
    path_a, path_b = path_a or tokenizer_path(FILE_A), path_b or tokenizer_path(FILE_B)
    rows = saved(spark, linked(docs, path_a, path_b), "aligned")
    _, b_of = tokenizers(path_a, path_b).pairs()
    found = pair_counts(rows, len(b_of)).toPandas()
    counts = np.zeros(len(b_of), np.int64)
    counts[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    best = np.zeros(int(b_of.max()) + 1, np.int64)
    np.maximum.at(best, b_of, counts)
    shared = spark.sparkContext.broadcast((counts, counts == best[b_of]))
    names = [c.split()[0] for c in SCORED_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, is_best = shared.value
        for batch in batches:
            n_best, total = [], []
            for links in batch.column("links"):
                link = np.frombuffer(links.as_buffer(), "<i4")
                n_best.append(int(is_best[link].sum()))
                total.append(int(counts[link].sum()))
            columns = {c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
            columns |= {"n_links": columns["n_groups"], "n_best": pa.array(n_best, pa.int64()),
                        "count_sum": pa.array(total, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return rows.mapInArrow(run, SCORED_SCHEMA)
