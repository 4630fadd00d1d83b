"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.llm.common import WORD_RE, saved, text_or_empty, whole_row

MAX_REPEATS = 3
SEED = "mix-1"


def size_of(text: str = "text") -> Column:
    """Words of a text; null and empty texts have none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD_RE)).cast("long")


def source_rates(docs: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    Sources in code point order (null last) weigh 1, 2, 3, repeating, and share
    all words by weight. A target stops at ``max_repeats`` times its source's
    size and the excess is shared anew by weight until none is above. That
    fixed point is found in closed form: with sources sorted by cap / weight,
    one level L exists with target = min(cap, L * weight). An empty table gives
    no rows; a source without words has target and rate 0. The windows run over
    one row per source, after the aggregate."""
    per = docs.select("source", size_of().alias("n")).groupBy("source").agg(
        F.sum("n").alias("source_size"))
    # code point order: compared as UTF-8 bytes
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("pos", F.row_number().over(by_name))
              .withColumn("weight", (F.col("pos") - 1) % 3 + 1)
              .withColumn("cap", F.col("source_size") * max_repeats)
              .withColumn("total", F.sum("source_size").over(everything)))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "pos")
    per = (per.withColumn("used", F.coalesce(F.sum("cap").over(
                  by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(
                  by_level.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", (F.col("total") - F.col("used")).cast("double")
                          / F.col("weight_left")))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("used", "level"))
    per = per.withColumn("level", F.min(fits).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"),
                                                   F.lit(float(max_repeats)))).otherwise(F.lit(0.0))
    return per.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def chance(seed: str, doc_id: str, text: str = "text") -> Column:
    """Uniform in [0, 1), a function of the seed, the id and the text alone (52
    bits of MD5), so that rows without an id draw each for themselves."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
                   F.md5(text_or_empty(text)))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def copies(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``row`` (all columns of ``docs``), ``doc_id, size, source_size, target, copies``.

    ``copies`` is floor(rate) plus one Bernoulli copy whose chance is the
    fraction. Rows that repeat a doc_id and its text share a draw. The rates are written
    once, so the planner knows their size: a small table is broadcast by its
    own threshold, a large one is joined by shuffle."""
    rates = saved(spark, source_rates(docs), "mix-rates").select(
        F.col("source").alias("of"), "source_size", "target", "rate")
    rows = docs.select(whole_row(docs), "doc_id", "source", size_of().alias("size"), chance(seed, "doc_id").alias("draw"))
    whole = F.floor("rate")
    extra = (F.col("draw") < F.col("rate") - whole).cast("long")
    return rows.join(rates, rows["source"].eqNullSafe(rates["of"])).select(
        "row", "doc_id", "size", "source_size", "target", (whole + extra).alias("copies"))


def mix(spark: SparkSession, docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the
    columns of ``docs``. Copies of a row are equal rows."""
    many = copies(spark, docs, seed).where("copies > 0")
    return many.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op9_mix_sources(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """What the mix takes of every document: taken = copies times size."""
    return copies(spark, docs).select("doc_id", "size", "source_size", "target",
                                      (F.col("copies") * F.col("size")).cast("long").alias("taken"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS body,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos,
    sum(source_size) OVER ()::BIGINT AS total FROM s),
w AS (SELECT *, (pos - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM p),
l AS (SELECT *, cap::DOUBLE / weight AS at_cap,
    (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, pos
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, pos
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w),
f AS (SELECT level FROM l WHERE level <= at_cap ORDER BY at_cap, pos LIMIT 1),
t AS (SELECT l.source, l.source_size, least(l.cap::DOUBLE, f.level * l.weight) AS target
  FROM l, f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE)
    ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, r.target,
  (d.size * (floor(rate)::BIGINT + CASE WHEN
     ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.body), 1, 13))::BIGINT::DOUBLE
     / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
