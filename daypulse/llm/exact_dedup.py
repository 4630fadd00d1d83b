"""Exact deduplication through a minimal perfect hash over recorded digests."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import SPACE_RE, saved, shuffle_tasks, text_or_empty, whole_row

SLOTS_PER_SHARD = 50_000
#: A digest with this share of all rows is looked up in as many tasks as PARTS.
HOT_SHARE, PARTS = 1_600, 64
GAMMA, LEVELS = 2.0, 40
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def digested(docs: DataFrame) -> DataFrame:
    """``doc_id, n_points, digest, place`` of every row; null text counts as empty.
    The digest is SHA-256 over the text without its white space; ``place`` tells
    rows apart that are equal in all else, once the frame is saved."""
    bare = F.regexp_replace(text_or_empty(), SPACE_RE, "")
    return docs.select("doc_id", F.length(text_or_empty()).alias("n_points"),
                       F.unhex(F.sha2(bare, 256)).alias("digest"),
                       F.monotonically_increasing_id().alias("place"))


def _keys(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests[:, 8:24]).view(np.uint64).reshape(-1, 2)
    return words[:, 0], words[:, 1] | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    x = a + b * np.uint64(level + 1)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def build_slots(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Minimal perfect hash over distinct 32-byte digests (rows of ``digests``).

    Level by level, keys that meet no other key in a bit array keep their
    place; the rest go to the next level. A key's slot is the rank of its bit.
    Returns the levels' bits (bool) and each digest's slot. Digests that still
    collide after the last level (equal in 128 bits) take the last slots, found
    by search."""
    a, b = _keys(digests)
    slot = np.full(len(digests), -1, np.int64)
    left, levels, base = np.arange(len(digests)), [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(1, math.ceil(GAMMA * len(left)))
        at = _place(a[left], b[left], level, size)
        bits = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(bits) - 1
        alone = bits[at]
        slot[left[alone]] = base + rank[at[alone]]
        base += int(bits.sum())
        levels.append(bits)
        left = left[~alone]
    slot[left] = base + np.arange(len(left))
    return levels, slot


def find_slots(levels: list[np.ndarray], table: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, or -1: the slot's full digest is compared byte by byte."""
    found = np.full(len(digests), -1, np.int64)
    if not len(table) or not len(digests):
        return found
    a, b = _keys(digests)
    left, base = np.arange(len(digests)), 0
    for level, bits in enumerate(levels):
        at = _place(a[left], b[left], level, len(bits))
        hit = bits[at]
        found[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        base += int(bits.sum())
        left = left[~hit]
    for extra in range(base, len(table)):
        same = (digests[left] == table[extra]).all(axis=1)
        found[left[same]] = extra
        left = left[~same]
    held = np.where(found >= 0, found, 0)
    return np.where((found >= 0) & (table[held] == digests).all(axis=1), found, -1)


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(v) for v in values), np.uint8).reshape(-1, 32)


def _pack(levels: list[np.ndarray]) -> list[bytes]:
    return [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in levels]


def _unpack(blobs) -> list[np.ndarray]:
    out = []
    for x in blobs:
        x = bytes(x)
        n = int.from_bytes(x[:8], "little")
        out.append(np.unpackbits(np.frombuffer(x[8:], np.uint8), count=n).astype(bool))
    return out


def _shard(n_shards: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"),
                  F.lit(n_shards)).cast("int")


INDEX_SCHEMA = "shard int, levels array<binary>, table binary, winners array<struct<place:bigint,keep_id:bigint,size:bigint>>"


def build_index(history: DataFrame, n_shards: int, hot: DataFrame) -> DataFrame:
    """One row per shard of a history of distinct ``digest, place, keep_id,
    group_size`` rows. Slots hold the full digest, the winner's locator (its place
    and id) and the group's size. Digests spread evenly over shards, so a shard
    holds SLOTS_PER_SHARD of them at most, about; the few ``hot`` ones form an index of
    their own, one copy for each of the negative shards."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(rows["digest"])
        levels, slot = build_slots(digests)
        order = np.argsort(slot)
        held = rows.iloc[order]
        winners = [{"place": p, "keep_id": None if pd.isna(i) else int(i), "size": n}
                   for p, i, n in zip(held["place"], held["keep_id"], held["group_size"])]
        return pd.DataFrame({"shard": [key[0]], "levels": [_pack(levels)],
                             "table": [digests[order].tobytes()], "winners": [winners]})

    every = F.sequence(F.lit(-PARTS), F.lit(-1))
    mine = F.array(_shard(n_shards))
    dealt = history.join(F.broadcast(hot), "digest", "left").withColumn(
        "shard", F.explode(F.when(F.col("hot"), every).otherwise(mine)))
    return dealt.drop("hot").groupBy("shard").applyInPandas(build, INDEX_SCHEMA)


FOUND_SCHEMA = ("doc_id bigint, n_points int, digest binary, place bigint, member boolean, "
                "winner bigint, keep_id bigint, group_size bigint")


def look_up(index: DataFrame, n_shards: int, rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Each row with what its digest's slot holds: the place and id of the winner
    and the group's size. ``member`` is false where no slot holds the digest,
    compared byte by byte; such a row is a group of its own. Rows of a hot digest
    are dealt to PARTS shards."""

    def probe(key: tuple, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        at = np.full(len(rows), -1, np.int64)
        winners: list = []
        if len(shard) and len(rows):
            s = shard.iloc[0]
            table = np.frombuffer(bytes(s["table"]), np.uint8).reshape(-1, 32)
            at, winners = find_slots(_unpack(s["levels"]), table, _matrix(rows["digest"])), list(s["winners"])
        out = rows.drop(columns="shard")
        own = zip(rows["place"], rows["doc_id"])
        found = [(winners[k]["place"], winners[k]["keep_id"], winners[k]["size"]) if k >= 0 else (p, i, 1)
                 for k, (p, i) in zip(at, own)]
        out["member"] = at >= 0
        for k, name in enumerate(("winner", "keep_id", "group_size")):
            values = [f[k] for f in found]
            out[name] = pd.Series([None if pd.isna(v) else int(v) for v in values], dtype="object", index=out.index)
        return out

    part = -1 - F.pmod(F.xxhash64("place"), F.lit(PARTS)).cast("int")
    dealt = rows.join(F.broadcast(hot), "digest", "left").withColumn(
        "shard", F.when(F.col("hot"), part).otherwise(_shard(n_shards)))
    dealt = dealt.select("doc_id", "n_points", "digest", "place", "shard")
    return dealt.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe, FOUND_SCHEMA)


def recorded(rows: DataFrame) -> DataFrame:
    """The history: every distinct digest with the place and id of its winner (most
    code points, then smallest id, null ids last) and the number of its rows. One
    aggregate with map-side combine."""
    best = F.min(F.struct((-F.col("n_points")).alias("short"),
                          F.col("doc_id").isNull().alias("no_id"), "doc_id", "place"))
    return rows.groupBy("digest").agg(best.alias("b"), F.count("*").alias("group_size")).select(
        "digest", F.col("b.place").alias("place"), F.col("b.doc_id").alias("keep_id"), "group_size")


def dedup(spark: SparkSession, docs: DataFrame, slots_per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """``doc_id, n_points, digest, keep_id, group_size, kept, member`` per row.

    The index holds the digests recorded more than once, the only ones that can
    remove a row. Every row looks its digest up in it and nothing else decides: a
    member stays only where the slot names its own place, a nonmember is a group
    of its own. Null text is empty text; a null id is larger than any other; of
    rows equal in id and text one stays; an empty table gives an empty result."""
    rows = saved(spark, digested(docs), "exact-rows")
    history = saved(spark, recorded(rows).where("group_size > 1"), "exact-history")
    total, repeated = rows.count(), history.count()
    # at most HOT_SHARE digests can have that share of the rows
    hot = saved(spark, history.where(F.col("group_size") * HOT_SHARE >= total)
                .select("digest", F.lit(True).alias("hot")), "exact-hot")
    n_shards = max(shuffle_tasks(spark), math.ceil(max(repeated / slots_per_shard, total / (8 * slots_per_shard))))
    index = saved(spark, build_index(history, n_shards, hot), "exact-index")
    found = look_up(index, n_shards, rows, hot)
    return found.select("doc_id", "n_points", "digest", "keep_id", "group_size",
                        (F.col("winner") == F.col("place")).alias("kept"), "member")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``. The join
    keys name single rows, so no group of copies meets in one task."""
    keys = ["digest", "name", "n_points"]
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("name")
    kept = dedup(spark, docs).where("kept").select("digest", name, "n_points")
    bare = F.unhex(F.sha2(F.regexp_replace(text_or_empty(), SPACE_RE, ""), 256))
    marked = docs.select(whole_row(docs), bare.alias("digest"), name, F.length(text_or_empty()).alias("n_points"))
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select("row.*")


def op4_exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup(spark, docs).select("doc_id", "keep_id", "group_size", "kept",
                                     F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM k
"""
