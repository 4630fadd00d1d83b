"""Balanced label propagation: equal texts move together under shard quotas."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.llm.common import ranked, saved, shuffle_tasks, text_or_empty

N_SHARDS = 40
#: Propagation ends after so many rounds on end, each with new ties, that moved nothing.
QUIET = 4


def items(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, link``: rows with equal ``link`` (equal texts)
    are linked. Null text has no bytes and counts as empty."""
    text = text_or_empty()
    return docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("link"))


def home(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_shards)).cast("int")


def running_before(df: DataFrame, keys: list[str], order: list[str], weight: str, out: str,
                   buckets: int) -> DataFrame:
    """Sum of ``weight`` of the rows before each row within ``keys``, by parts as
    in ``ranked``, so that no key meets in one task."""
    part = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    split = df.withColumn("_part", part)
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    parts = split.groupBy(*keys, "_part").agg(F.sum(weight).alias("_w"))
    over = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_w").over(over), F.lit(0))).drop("_w")
    return (split.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
                 .join(parts, [*keys, "_part"])
                 .withColumn(out, F.col("_in") + F.col("_base")).drop("_part", "_in", "_base"))


def seats(sizes: list[tuple[bytes, int]], quota: list[int]) -> list[tuple[bytes, int, int]]:
    """``link, shard, n``: large groups first, each whole in the shard it leaves
    least room in; one that fits nowhere fills the emptiest shard and goes on."""
    free, out = list(quota), []
    for link, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        while size:
            fits = [s for s, n in enumerate(free) if n >= size]
            at = min(fits, key=free.__getitem__) if fits else max(range(len(free)), key=free.__getitem__)
            n = min(size, free[at])
            out.append((link, at, n))
            free[at] -= n
            size -= n
    return out


def fitted(spark: SparkSession, mass: DataFrame, quota: list[int], buckets: int) -> DataFrame:
    """``mass`` with what passes the quotas dealt to the free room of other shards."""
    rows = spark.createDataFrame(list(enumerate(quota)), "shard int, quota long")
    over = running_before(mass, ["shard"], ["link"], "n", "before", buckets).join(F.broadcast(rows), "shard")
    over = saved(spark, over.select("link", "shard", "n", F.greatest(F.least(
        F.col("n"), F.col("quota") - F.col("before")), F.lit(0)).alias("kept")), "shard-over")
    until, spots = 0, []
    for s, n in enumerate(loads(over, "kept", len(quota))):
        spots.append((s, until, until + quota[s] - n))
        until = spots[-1][2]
    out = over.where("n > kept").select("link", "shard", (F.col("n") - F.col("kept")).alias("n"), F.lit(0).alias("all"))
    out = running_before(out, ["all"], ["link", "shard"], "n", "before", buckets)
    spot = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(x).cast("long").alias("a"), F.lit(y).cast("long").alias("b"))
                     for s, x, y in spots])
    out = out.select("link", "n", "before", F.explode(F.filter(
        spot, lambda p: (p.a < F.col("before") + F.col("n")) & (p.b > F.col("before")))).alias("p"))
    out = out.select("link", "p.shard", (F.least(F.col("p.b"), F.col("before") + F.col("n"))
                                         - F.greatest(F.col("p.a"), F.col("before"))).alias("n"))
    return (over.select("link", "shard", F.col("kept").alias("n")).unionByName(out)
                .groupBy("link", "shard").agg(F.sum("n").alias("n")).where("n > 0"))


def loads(mass: DataFrame, weight: str, n_shards: int) -> list[int]:
    held = {r["shard"]: r["n"] for r in mass.groupBy("shard").agg(F.sum(weight).alias("n")).collect()}
    return [held.get(s, 0) for s in range(n_shards)]


def requests(spark: SparkSession, mass: DataFrame, quota: list[int], room: list[int], round_no: int) -> DataFrame:
    """``link, shard, goal, n``: rows of a group that ask to go from shard to goal.

    Rows of a group that share a shard are alike, so they move as a mass. The
    goals of a group are the shards that hold most of it (ties by a hash), as
    many as it needs: by their quotas in even rounds; in odd ones by their room,
    so that full shards are passed over. The masses elsewhere are dealt to the
    goals in turn, and none asks for a shard that holds less than its own."""
    rows = spark.createDataFrame([(s, q, r) for s, (q, r) in enumerate(zip(quota, room))],
                                 "shard int, quota long, room long")
    group = Window.partitionBy("link")
    order = group.orderBy(F.desc("n"), F.xxhash64("link", "shard", F.lit(round_no)), "shard")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def ahead(weight: Column) -> Column:
        return F.coalesce(F.sum(weight).over(before), F.lit(0))

    open_ = F.lit(True) if round_no % 2 == 0 else (F.col("room") > 0) | (F.col("rank") == 1)
    cap = F.col("quota") if round_no % 2 == 0 else F.col("n") + F.col("room")
    seen = (mass.join(F.broadcast(rows), "shard").withColumn("rank", F.row_number().over(order))
                .withColumn("cap", F.when(open_, cap).otherwise(F.lit(0)))
                .withColumn("goal", open_ & (ahead(F.col("cap")) < F.sum("n").over(group)))
                .withColumn("space", F.when(F.col("goal"), F.col("cap") - F.col("n")).otherwise(F.lit(0)))
                .withColumn("asks", F.when(F.col("goal"), F.lit(0)).otherwise(F.col("n"))))
    seen = seen.withColumn("a", ahead(F.col("asks"))).withColumn("b", F.col("a") + F.col("asks"))
    goal = F.when(F.col("goal"), F.struct("shard", "rank", ahead(F.col("space")).alias("a"), (
        ahead(F.col("space")) + F.col("space")).alias("b")))
    seen = seen.withColumn("goals", F.collect_list(goal).over(group))  # at most one per shard
    met = seen.where("asks > 0").select("link", "shard", "a", "b", F.explode(F.filter("goals", lambda g: (
        (g.rank < F.col("rank")) & (g.a < F.col("b")) & (g.b > F.col("a"))))).alias("g"))
    return met.select("link", "shard", F.col("g.shard").alias("goal"), (
        F.least(F.col("b"), F.col("g.b")) - F.greatest(F.col("a"), F.col("g.a"))).alias("n"))


def served(asked: np.ndarray, room: list[int]) -> np.ndarray:
    """How many of the rows that ask to go from shard to shard may: as many as
    can without any shard growing by more than its room. Rows that leave make
    room for others, so full shards exchange rows, in pairs or in longer rings.

    A circulation of most rows: a further node gives and takes what shards gain
    or lose, and rings of a positive gain are pushed until there is none."""
    n = len(room)
    limit, gain = np.zeros((2, n + 1, n + 1), np.int64)
    limit[:n, :n], limit[:n, n], limit[n, :n] = asked, room, asked.sum()
    gain[:n, :n] = 1
    flow = np.zeros_like(limit)
    flow[:n, :n] = np.minimum(asked, asked.T)
    while True:
        more = limit > flow
        step = np.where(more, gain, np.where(flow.T > 0, -gain.T, -(1 << 40)))
        np.fill_diagonal(step, -(1 << 40))
        best, came = np.zeros(n + 1, np.int64), np.full(n + 1, -1)
        for _ in range(n + 1):
            reach = best[:, None] + step
            new = reach.max(axis=0)
            better = new > best
            if not better.any():
                return flow[:n, :n]
            came[better] = reach.argmax(axis=0)[better]
            best = np.maximum(best, new)
        at = int(np.flatnonzero(better)[0])
        for _ in range(n + 1):  # back into the ring
            at = int(came[at])
        ring = [at]
        while came[ring[-1]] != at:
            ring.append(int(came[ring[-1]]))
        edges = [(int(came[v]), v) for v in ring]
        size = min(limit[u, v] - flow[u, v] if more[u, v] else flow[v, u] for u, v in edges)
        for u, v in edges:
            if more[u, v]:
                flow[u, v] += size
            else:
                flow[v, u] -= size


def propagated(spark: SparkSession, mass: DataFrame, quota: list[int], buckets: int) -> DataFrame:
    """Rounds of propagation over ``link, shard, n`` (linked rows per shard) that
    pass no quota, until none moves a row. Rows go only where more of their group
    is, so the squares of the masses add up to more after each move: no round
    undoes another, and the rounds end."""
    k = quiet = 0
    while quiet < QUIET:
        held = loads(mass, "n", len(quota))
        room = [q - n for q, n in zip(quota, held)]
        asks = saved(spark, requests(spark, mass, quota, room, k), f"shard-asks-{k}")
        asked = np.zeros((len(quota), len(quota)), np.int64)
        for r in asks.groupBy("shard", "goal").agg(F.sum("n").alias("n")).collect():
            asked[r["shard"], r["goal"]] = r["n"]
        if k % 2 == 0 and not asked.any():
            break  # no group is cut more than its size demands
        may = served(asked, room)
        if may.any():
            rows = [(int(a), int(b), int(may[a, b])) for a, b in zip(*np.nonzero(may))]
            may = F.broadcast(spark.createDataFrame(rows, "shard int, goal int, may long"))
            go = running_before(asks, ["shard", "goal"], ["link"], "n", "before", buckets).join(may, ["shard", "goal"])
            go = go.select("link", "shard", "goal", F.least(F.col("n"), F.col("may") - F.col("before")).alias("n"))
            go = go.where("n > 0").select("link", F.explode(F.array(
                F.struct("shard", (-F.col("n")).alias("n")), F.struct(F.col("goal").alias("shard"), "n"))).alias("m"))
            mass = saved(spark, mass.unionByName(go.select("link", "m.shard", "m.n")).groupBy("link", "shard").agg(
                F.sum("n").alias("n")).where("n > 0"), f"shard-mass-{k}")
            quiet = 0
        else:
            quiet += 1
        k += 1
    return mass


def shard(spark: SparkSession, docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, link, shard, slot`` under the law ``rows``:
    counts of the shards are at most one apart.

    Large groups start in as few shards as hold them, other linked rows in the
    shard of their hash, or where there is room if it is full; rounds move them towards their neighbours under the quotas until none
    moves. Rows that no text links then fill what is left of the quotas. Null ids
    and texts are values like any other; equal rows are linked rows; an empty
    table gives no rows. What reaches the driver has one row per pair of shards."""
    buckets = shuffle_tasks(spark)
    rows = saved(spark, items(docs).withColumn("home", home(n_shards)), "shard-items")
    total = rows.count()
    quota = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    # counts per text and shard come first, so that no later step meets the rows of a text
    mass = saved(spark, rows.groupBy("link", F.col("home").alias("shard")).agg(F.count("*").alias("n")), "shard-home")
    sizes = mass.groupBy("link").agg(F.sum("n").alias("size")).where("size > 1")
    # at most n_shards ** 2 groups are as large as that, and no round could bring
    # them together once small groups are whole around them
    large = sizes.where(F.col("size") * n_shards ** 2 >= total).collect()
    large = spark.createDataFrame(seats([(bytes(r["link"]), r["size"]) for r in large], quota),
                                  "link binary, shard int, n long")
    small = mass.join(sizes.where(F.col("size") * n_shards ** 2 < total).select("link"), "link")
    small = saved(spark, small.select("link", "shard", "n"), "shard-mass")
    left = [q - n for q, n in zip(quota, loads(large, "n", n_shards))]
    mass = saved(spark, fitted(spark, small, left, buckets).unionByName(large), "shard-fitted")
    mass = propagated(spark, mass, quota, buckets)
    by_shard = Window.partitionBy("link").orderBy("shard")
    spans = mass.withColumn("until", F.sum("n").over(
        by_shard.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("link").agg(F.sort_array(F.collect_list(
        F.struct("until", "shard"))).alias("spans"))  # at most n_shards per group
    order = ["doc_id", "text_crc32"]
    in_group = ranked(rows.drop("home"), ["link"], order, "nth", buckets)
    # null: rows that nothing links
    placed = in_group.join(spans, "link", "left").withColumn(
        "shard", F.expr("get(filter(spans, s -> nth < s.until), 0).shard")).drop("spans", "nth")
    both = saved(spark, placed, "shard-both")

    taken = {r["shard"]: r["n"] for r in both.where("shard is not null").groupBy("shard").agg(
        F.count("*").alias("n")).collect()}
    until, ends = 0, []
    for s in range(n_shards):
        until += quota[s] - taken.get(s, 0)
        ends.append(until)
    loose = both.where("shard is null").drop("shard").withColumn("all", F.lit(0))
    loose = ranked(loose, ["all"], ["doc_id", "text_crc32", "link"], "nth", buckets)
    spot = F.array(*[F.lit(e).cast("long") for e in ends])
    loose = loose.withColumn("shard", F.size(F.filter(spot, lambda e: e <= F.col("nth"))))
    done = both.where("shard is not null").unionByName(loose.drop("all", "nth"))
    return ranked(done, ["shard"], ["doc_id", "text_crc32", "link"], "slot", buckets)


def cut_links(sharded: DataFrame) -> DataFrame:
    """Links of each group to its first shard that are cut: rows outside the
    shard that holds most of the group."""
    per = sharded.groupBy("link", "shard").agg(F.count("*").alias("n"))
    return per.groupBy("link").agg((F.sum("n") - F.max("n")).alias("cut"))


def op7_balanced_sharding(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return shard(spark, docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
