"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.session import work_path

#: Words are runs of anything but these six characters (space, TAB to CR).
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"


#: Whole texts travel to Python in batches of this many rows; Spark's default of
#: 10,000 suits narrow rows and holds hundreds of MB of text per task.
BATCH_ROWS = 1_000


def text_batches(spark: SparkSession) -> SparkSession:
    """The session with batches of BATCH_ROWS, unless its user has set a size."""
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared work folder and read back: cuts the
    lineage, survives lost executors, and gives the planner true sizes."""
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def hashed_sample(df: DataFrame, keys: list[str], bound: int, total: int) -> DataFrame:
    """At most ``bound`` of the ``total`` rows, those with the smallest hashes of
    ``keys``. Rows whose hash is surely too large go first, so that no task sends
    more than its share of the sample."""
    share = min(1.0, 1.2 * (bound + 1_000) / max(1, total))
    few = df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return few.orderBy(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)), *keys).limit(bound)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, ``row``: whatever their names, they
    cannot clash with those that an operator adds. ``select("row.*")`` undoes it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, buckets: int) -> DataFrame:
    """Adds ``out``: a gapless rank from 0 of the rows within ``keys``.

    A plain window would put a hot key into one task. Here each key is split
    into ``buckets`` parts by a hash of ``order``; rows are ranked inside their
    part and moved up by the sizes of the parts before it (at most ``buckets``
    rows a key). The rank depends on the values of ``order`` alone, so a rerun
    gives the same ranks; rows equal in ``order`` take any of their ranks."""
    cols = df.columns
    split = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    local = split.withColumn("_local", F.row_number().over(
        Window.partitionBy(*keys, "_part").orderBy(*order)) - F.lit(1))
    sizes = split.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("_n")
    before = before.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           F.col("_part").alias("_k_part"), "_before")
    same = (F.col("_part") == F.col("_k_part"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return local.join(before, same).select(
        *cols, (F.col("_local") + F.col("_before")).cast("long").alias(out))
