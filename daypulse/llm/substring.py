"""Removal of repeated passages: winnowed anchors are seeds, joined across
documents, extended both ways, and kept where a repeat is long enough.

The words of every document are hashed, and of each window of LENGTH words the
k-gram with the smallest hash is its anchor (winnowing): two equal windows have
the same anchor at the same place, so no repeat of LENGTH words or more is
missed, while only about one word in five is an anchor.

1. Seeds: anchors meet by their hash; those that stand in two documents or more
   are seeds. Others, nearly all of an unrepeated text, end here.
2. Extension: around each seed every window that holds it is a candidate, the
   seed extended to both sides to LENGTH words. Equal extensions meet by their
   64-bit hash in the shard of their anchor, and the smallest doc_id owns them.
   No pairs of documents are formed: a passage that thousands share costs its
   bucket one document's entries per chunk and window.
3. Maximal repeats: found windows that touch join to spans, each as long as its
   text goes on to repeat, and none shorter than LENGTH words.

Both meetings are shuffles of packed arrays, one row per task-sized chunk of
documents and bucket. A chunk first settles what repeats inside it; what is
settled goes to the shard of its documents and never to the bucket of its key.
To the bucket go the entries of one document per key, so a hot key meets those of
as many documents as there are chunks at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import shuffle_tasks

LENGTH = 13
GRAM = 5
CHUNK_BYTES = 16 << 20
HASH_BYTES = 1 << 20  # texts hashed at a time
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_OF_BYTE = np.where(_SPACE, _U(0), _mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE)))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(n, _BASE, np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and each text's number of words."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    space = _SPACE[raw]
    change = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
    starts, ends = change[::2], change[1::2]
    up, down = _POWERS.to(len(raw))
    total = np.concatenate([[_U(0)], np.cumsum(_OF_BYTE[raw] * up[:len(raw)])])
    hashes = _mix((total[ends] - total[starts]) * down[starts])
    before = np.searchsorted(starts, np.cumsum(sizes))
    return hashes, np.diff(np.concatenate([[0], before]))


def rolling(hashes: np.ndarray, at: np.ndarray | slice, size: int, salt: int) -> np.ndarray:
    """Hash of ``size`` words from each place on."""
    out = np.zeros(len(hashes[at]), np.uint64)
    for k in range(size):
        shifted = hashes[at + k] if isinstance(at, np.ndarray) else hashes[at.start + k:at.stop + k]
        out = out * _U(0xD6E8FEB86659FD93) + shifted
    return _mix(out + _U(salt))


def anchors(hashes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of one text: the place of its anchor and the anchor's hash."""
    n = len(hashes) - length + 1
    grams = rolling(hashes, slice(0, len(hashes) - gram + 1), gram, 1)
    reach = length - gram + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(axis=1) + np.arange(n)
    return place, grams[place]


def texts_of(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[list[tuple]]:
    """Rows (doc_id, text bytes, ...) in chunks of about CHUNK_BYTES."""
    held, size = [], 0
    for batch in batches:
        columns = [batch.column(c) for c in more]
        for k, (name, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            held.append((name, raw, *(c[k].as_py() for c in columns)))
            size += len(raw)
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def hashed(rows: list[tuple], length: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(row, word hashes) of the rows with ``length`` words or more."""
    k = 0
    while k < len(rows):
        end, size = k, 0
        while end < len(rows) and (end == k or size + len(rows[end][1]) <= HASH_BYTES):
            size += len(rows[end][1])
            end += 1
        hashes, counts = word_hashes([r[1] for r in rows[k:end]])
        stop = np.cumsum(counts)
        for row, n, b in zip(rows[k:end], counts, stop):
            if n >= length and row[0] is not None:
                yield row, hashes[b - n:b]
        k = end


# -- meetings of keys --------------------------------------------------------------
# A row carries entries (key, doc_id, place) of one chunk for one bucket; the
# doc_ids as runs. Settled rows are results that the chunk found itself. Their
# bucket is ``buckets`` plus the shard of their documents.

MEET_SCHEMA = "bucket int, settled boolean, keys binary, docs binary, runs binary, places binary"
_MEET = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("keys", pa.binary()),
                   ("docs", pa.binary()), ("runs", pa.binary()), ("places", pa.binary())])


def packed(bucket: np.ndarray, keys: np.ndarray, docs: np.ndarray, places: np.ndarray,
           settled: bool, key_type) -> Iterator[dict]:
    """Entries as rows, one per bucket, sorted by document and place."""
    order = np.lexsort((places, docs, bucket))
    bucket, keys, docs, places = bucket[order], keys[order], docs[order], places[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
    for a, b in zip(edges, edges[1:]):
        mine = docs[a:b]
        first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        yield {"bucket": int(bucket[a]), "settled": settled,
               "keys": b"" if settled else keys[a:b].astype(key_type).tobytes(),
               "docs": mine[first].tobytes(),
               "runs": np.diff(np.append(first, b - a)).astype(np.uint32).tobytes(),
               "places": np.diff(places[a:b], prepend=0).astype(np.int32).tobytes()}


def unpacked(rows: pa.Table, key_type) -> tuple[np.ndarray, ...]:
    """(row number, key, doc_id, place) of all entries."""
    number, keys, docs, places = [], [], [], []
    for k, r in enumerate(rows.to_pylist()):
        runs = np.frombuffer(r["runs"], np.uint32)
        docs.append(np.repeat(np.frombuffer(r["docs"], np.int64), runs))
        places.append(np.cumsum(np.frombuffer(r["places"], np.int32), dtype=np.int64))
        keys.append(np.frombuffer(r["keys"], key_type))
        number.append(np.full(len(docs[-1]), k))
    if not docs:
        return tuple(np.zeros(0, t) for t in (np.int64, key_type, np.int64, np.int64))
    return tuple(map(np.concatenate, (number, keys, docs, places)))


FOUND_SCHEMA = "shard int, docs binary, runs binary, places binary"
_FOUND = pa.schema([("shard", pa.int32()), ("docs", pa.binary()), ("runs", pa.binary()), ("places", pa.binary())])


def shard_of(docs: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(docs.view(np.uint64)) % _U(shards)).astype(np.int32)


def settled_rows(docs: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[dict]:
    """Found places of one chunk, for the shards of their documents."""
    return packed(buckets + shard_of(docs, buckets), np.zeros(len(docs), np.uint32), docs, places, True, np.uint32)


def found_rows(docs: np.ndarray, places: np.ndarray, shards: int) -> pa.Table:
    """Found places on the way back to their documents: one row per shard of
    documents, however many documents a bucket has found."""
    rows = packed(shard_of(docs, shards), np.zeros(len(docs), np.uint32), docs, places, True, np.uint32)
    names = ("docs", "runs", "places")
    return pa.Table.from_pylist(
        [{"shard": r["bucket"], **{n: r[n] for n in names}} for r in rows], schema=_FOUND)


def by_document(rows: pa.Table) -> pa.Table:
    """All found places of the documents of a shard: one row per document."""
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in rows.to_pylist():
        docs.append(np.repeat(np.frombuffer(row["docs"], np.int64), np.frombuffer(row["runs"], np.uint32)))
        places.append(np.cumsum(np.frombuffer(row["places"], np.int32), dtype=np.int64))
    docs, places = np.concatenate(docs), np.concatenate(places)
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order].astype(np.int32)
    edges = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1], [True]])) if len(docs) else np.zeros(1, int)
    return pa.table({"doc_id": pa.array(docs[edges[:-1]], pa.int64()),
                     "places": pa.array([places[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())})


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, the first one leading, and a group number per first key."""
    order = np.lexsort(keys[::-1])
    lead = keys[0][order]
    new = np.concatenate([[True], lead[1:] != lead[:-1]]) if len(lead) else np.zeros(0, bool)
    return order, np.cumsum(new) - 1


def seed_rows(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in texts_of(batches):
            keys, names, places = [], [], []
            for row, hashes in hashed(rows, length):
                place = np.unique(anchors(hashes, length, gram)[0])
                keys.append(rolling(hashes, place, gram, 1))
                names.append(np.full(len(place), row[0], np.int64))
                places.append(place)
            if not keys:
                continue
            keys, names, places = map(np.concatenate, (keys, names, places))
            order, group = groups_of(keys, names)
            keys, names, places = keys[order], names[order], places[order]
            first = np.concatenate([[True], group[1:] != group[:-1]])
            lead = np.flatnonzero(first)
            several = (names != names[lead][group])
            shared = np.bincount(group, several) > 0
            mine = shared[group]
            send = ~mine | first
            bucket = ((keys >> _U(32)) % _U(buckets)).astype(np.int32)
            out = [*settled_rows(names[mine], places[mine], buckets),
                   *packed(bucket[send], keys[send], names[send], places[send], False, np.uint32)]
            yield pa.RecordBatch.from_pylist(out, schema=_MEET)

    return docs.select("doc_id", "text").mapInArrow(scan, MEET_SCHEMA)


def meet_seeds(rows: pa.Table, shards: int) -> pa.Table:
    """Places of seeds: anchors that two chunks sent."""
    number, keys, docs, places = unpacked(rows, np.uint32)
    order, group = groups_of(keys, number)
    number, docs, places = number[order], docs[order], places[order]
    lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    several = np.bincount(group, number != number[lead][group], minlength=len(lead)) > 0
    mine = several[group] if len(group) else np.zeros(0, bool)
    return found_rows(docs[mine], places[mine], shards)


def window_rows(candidates: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Windows around the seeds of ``doc_id, text, places``: in each chunk the
    smallest doc_id of a window is sent, larger ones are settled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in texts_of(batches, "places"):
            keys, names, places, shards = [], [], [], []
            for row, hashes in hashed(rows, length):
                n = len(hashes) - length + 1
                seeds = np.frombuffer(row[2], np.int32)
                open_ = np.zeros(len(hashes) + 2, np.int32)
                seeds = seeds[seeds < len(hashes)]
                np.add.at(open_, np.maximum(seeds - (length - gram), 0), 1)
                np.add.at(open_, seeds + 1, -1)
                at = np.flatnonzero(np.cumsum(open_)[:n] > 0)
                if not len(at):
                    continue
                keys.append(rolling(hashes, at, length, 2))
                shards.append(anchors(hashes, length, gram)[1][at])
                names.append(np.full(len(at), row[0], np.int64))
                places.append(at)
            if not keys:
                continue
            keys, names, places, shards = map(np.concatenate, (keys, names, places, shards))
            bucket = ((shards >> _U(32)) % _U(buckets)).astype(np.int32)
            order, group = groups_of(keys, names)
            keys, names, places, bucket = (x[order] for x in (keys, names, places, bucket))
            lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            later = names != names[lead][group]
            out = [*settled_rows(names[later], places[later], buckets),
                   *packed(bucket[~later], keys[~later], names[~later], places[~later], False, np.uint64)]
            yield pa.RecordBatch.from_pylist(out, schema=_MEET)

    return candidates.select("doc_id", "text", "places").mapInArrow(scan, MEET_SCHEMA)


def meet_windows(rows: pa.Table, shards: int) -> pa.Table:
    """Places of windows that also start in a document with a smaller id."""
    _, keys, docs, places = unpacked(rows, np.uint64)
    order, group = groups_of(keys, docs)
    docs, places = docs[order], places[order]
    lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    later = docs != docs[lead][group] if len(group) else np.zeros(0, bool)
    return found_rows(docs[later], places[later], shards)


def meet(rows: DataFrame, how, buckets: int) -> DataFrame:
    """``doc_id, places`` (sorted 32-bit integers) of what the entries' meeting
    finds: over buckets of keys, then back over shards of documents. Settled rows
    meet nothing on their way and are passed on as they are packed."""
    def one(bucket: pa.Table) -> pa.Table:
        at = bucket.column("bucket")[0].as_py()
        if at < buckets:
            return how(bucket, buckets)
        shard = pa.array(np.full(len(bucket), at - buckets, np.int32))
        return pa.table([shard, *(bucket.column(n) for n in _FOUND.names[1:])], schema=_FOUND)

    return (rows.groupBy("bucket").applyInArrow(one, FOUND_SCHEMA)
                .groupBy("shard").applyInArrow(by_document, "doc_id bigint, places binary"))


def repeated_windows(spark: SparkSession, docs: DataFrame, length: int = LENGTH,
                     gram: int = GRAM) -> DataFrame:
    """``doc_id, places``: starts of the windows of ``length`` words that also
    start in a document with a smaller id. Rows without an id take no part."""
    buckets = shuffle_tasks(spark)
    seeds = meet(seed_rows(docs, buckets, length, gram), meet_seeds, buckets)
    candidates = docs.select("doc_id", "text").join(seeds, "doc_id")
    return meet(window_rows(candidates, buckets, length, gram), meet_windows, buckets)


CUT_SCHEMA = ("doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,stop:int>>, "
              "kept_sha256 string, kept_text string")


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   with_text: bool = True) -> DataFrame:
    """Per row: its words, the maximal repeats (``spans`` of word numbers) that
    other documents with smaller ids hold, and the words left, joined by a
    space (null unless ``with_text``) with their digest.

    Windows are judged on the input, not on what is left. Null and empty texts
    have no words; a row with a null id keeps its words and lends none; rows
    that repeat a doc_id are one document, and each loses what any of them
    repeats at its place; an empty table gives an empty result."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                         batch.column("places").to_pylist()):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                kept, spans = words, []
                if found:
                    change = np.zeros(len(words) + 1, np.int32)
                    starts = np.unique(np.frombuffer(found, np.int32))
                    starts = starts[starts + length <= len(words)]
                    change[starts] += 1
                    change[starts + length] -= 1
                    gone = np.cumsum(change[:-1]) > 0
                    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    spans = [{"start": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    kept = [words[k] for k in np.flatnonzero(~gone).tolist()]
                joined = b" ".join(kept)
                rows.append({"doc_id": name, "n_words": len(words), "n_removed": len(words) - len(kept),
                             "spans": spans, "kept_sha256": hashlib.sha256(joined).hexdigest(),
                             "kept_text": joined.decode("utf-8", "surrogatepass") if with_text else None})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                        ("kept_sha256", pa.string()), ("kept_text", pa.string())])
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = repeated_windows(spark, texts, length, gram)
    return texts.join(found, "doc_id", "left").select("doc_id", "text", "places").mapInArrow(cut, CUT_SCHEMA)


def op2_substring_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(spark, docs, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM hit, (SELECT unnest(range(0, 13)) AS o)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
