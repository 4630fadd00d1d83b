"""SimHash near-duplicates with vantage-point trees over Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import hashed_sample, saved, text_or_empty, whole_row

SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Fingerprints (bounded, by a hashed order) that only choose vantage points.
TREE_SAMPLE = 50_000
SHARD_POINTS = 4_096
BRUTE_POINTS = 1_024


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash: bit b is 1 if it is set in over half of the shingle
    hashes (repeats count). Fewer words than a shingle: the whole sequence;
    no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1).tolist()
    n = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    hash64 = xxhash.xxh64_intdigest
    found = np.fromiter((hash64(line[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)
    bits = np.unpackbits(found.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def text_hash():
    return F.xxhash64(text_or_empty()).alias("text_hash")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, text_hash, fp`` (signed 64 bits) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_hash(), "text").mapInArrow(
        scan, "doc_id bigint, text_hash bigint, fp bigint")


# -- vantage-point trees ------------------------------------------------------

def split(points: np.ndarray, reach: int, pick: int) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve ``points`` best. The inner side takes
    distances up to radius + reach, the outer those above the radius: a pair at
    most ``reach`` apart with one point inside is whole on the inner side, by
    the triangle inequality; any other pair is whole on the outer side. None if
    no radius makes both sides smaller by a twentieth at least."""
    vantage = points[pick % len(points)]
    count = np.bincount(np.bitwise_count(points ^ vantage), minlength=65 + reach)
    within = np.cumsum(count)
    radius = np.arange(64)
    worst = np.maximum(within[radius + reach], len(points) - within[radius])
    best = int(np.argmin(worst))
    return (vantage, best) if worst[best] <= 0.95 * len(points) else None


def top_tree(sample: np.ndarray, total: int, reach: int, shard_points: int) -> list:
    """Tree over the sample whose leaves would hold about ``shard_points`` of
    ``total`` points: nodes are [vantage, radius, inner, outer], leaves None."""
    limit = max(2, int(shard_points * len(sample) / max(1, total)))

    def grow(points: np.ndarray, depth: int) -> list | None:
        if len(points) <= limit or (cut := split(points, reach, 7919 * depth + 1)) is None:
            return None
        vantage, radius = cut
        d = np.bitwise_count(points ^ vantage)
        return [vantage, radius, grow(points[d <= radius + reach], depth + 1),
                grow(points[d > radius], depth + 1)]

    return grow(sample, 0)


def route(tree: list | None, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, points to send there): a point near a boundary goes to the
    shards on both sides."""
    stack, leaf = [(tree, points)], 0
    while stack:
        node, here = stack.pop()
        if node is None:
            if len(here):
                yield leaf, here
            leaf += 1
            continue
        vantage, radius, inner, outer = node
        d = np.bitwise_count(here ^ vantage)
        stack += [(outer, here[d > radius]), (inner, here[d <= radius + reach])]


class Links:
    """Connected components over 0..n-1: only labels are kept, never the pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            x, y = x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def link_points(points: np.ndarray, reach: int) -> np.ndarray:
    """Component label of each distinct point: exact pairs at most ``reach``
    apart, found in a vantage-point tree. Every inner node prunes the pairs
    that its triangle bound excludes; leaves compare all pairs in blocks."""
    links, stack, depth = Links(len(points)), [np.arange(len(points))], 0
    while stack:
        here = stack.pop()
        mine = points[here]
        depth += 1
        cut = split(mine, reach, 7919 * depth + 1) if len(here) > BRUTE_POINTS else None
        if cut is not None:
            d = np.bitwise_count(mine ^ cut[0])
            stack += [here[d > cut[1]], here[d <= cut[1] + reach]]
            continue
        for k in range(0, len(here), 256):
            near = np.bitwise_count(mine[k:k + 256, None] ^ mine[None, k:]) <= reach
            a, b = np.nonzero(near)
            off = a < b
            if off.any():
                links.add(here[k + a[off]], here[k + b[off]])
    return links.label


def near_links(spark: SparkSession, points: DataFrame, reach: int = MAX_BITS,
               shard_points: int = SHARD_POINTS, tree_sample: int = TREE_SAMPLE) -> DataFrame:
    """``a, b``: links that connect distinct fingerprints ``fp`` exactly as all
    pairs at most ``reach`` bits apart do, at most one per point and shard."""
    total = points.count()
    sample = hashed_sample(points, ["fp"], tree_sample, total).collect()
    sample = np.array([r["fp"] for r in sample], np.int64).view(np.uint64)
    tree = top_tree(sample, total, reach, shard_points)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, here in route(tree, fps, reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(here), leaf, np.int32)), pa.array(here.view(np.int64))],
                    names=["leaf", "fp"])

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy()
        label = link_points(fps.view(np.uint64), reach)
        joined = label != np.arange(len(fps))
        return pd.DataFrame({"a": fps[joined], "b": fps[label[joined]]})

    return (points.mapInArrow(send, "leaf int, fp bigint").groupBy("leaf")
                  .applyInPandas(link, "a bigint, b bigint"))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, label``: smallest node of each component of ``a, b`` links, by
    alternating large-star and small-star rounds until nothing changes. Each
    round is two aggregates with map-side combine and two joins, written out."""
    edges = saved(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "cc-links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .where("u <> v").distinct())
        large = saved(spark, large, "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pulled = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(spark, pulled.unionByName(low.select("u", F.col("m").alias("v")))
                      .where("u <> v").distinct(), "cc-small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    leaves = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    roots = leaves.select(F.col("label").alias("node")).distinct().withColumn("label", F.col("node"))
    return leaves.unionByName(roots)


def near_groups(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, label, component_id`` of every row: ``label`` is
    the smallest fingerprint and ``component_id`` the smallest doc_id reachable
    over fingerprints at most ``max_bits`` apart.

    Null and empty texts have fingerprint zero and are linked like any other. A
    null id never names a component that has another id. Repeated rows stay
    repeated; an empty table gives none."""
    rows = saved(spark, fingerprints(docs, shingle, seed), "simhash-rows")
    points = saved(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-points")
    found = components(spark, near_links(spark, points.select("fp"), max_bits))
    named = points.join(found, points["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label"))
    named = saved(spark, named, "simhash-labels")
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    names = named.join(least, "label").select("fp", "label", "component_id")
    return rows.join(names, "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, the one with the smallest id (null
    last), with the columns of ``docs``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("name")
    stay = near_groups(spark, docs).groupBy("label").agg(first).select("first.*").select(name, "text_hash")
    marked = docs.select(whole_row(docs), name, text_hash())
    return (marked.join(stay, ["name", "text_hash"], "left_semi")
                  .dropDuplicates(["name", "text_hash"]).select("row.*"))


def op5_simhash(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_groups(spark, docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
