"""Tables that micro-batches write part by part.

``path/<by>=<value>/part=b-<batch>`` holds the rows of one batch for one group
(a day, or a bucket of keys). A batch that is delivered again rewrites exactly
its own parts. Once a group has ``every`` batch parts they are merged into one
``part=m-<batch>``, so the files that a batch lists and reads do not grow with
the number of batches.

A merged part counts from the moment its success marker stands; it then stands
for every part up to its batch, whether those are deleted yet or not. So a crash
at any point neither loses nor doubles a row. The parts that a merge replaces are
deleted by the next merge, so a frame built before a merge still finds its files.
``part=r`` holds repaired rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.session import child_folders, delete_path, path_exists

REPAIR = "part=r"


def part_name(kind: str, batch_id: int) -> str:
    return f"{kind}-{batch_id:012d}"


def write_parts(df: DataFrame, path: str, by: str, part: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("part", F.lit(part))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by, "part").parquet(path))


def write_batch(df: DataFrame, path: str, by: str, batch_id: int) -> None:
    write_parts(df, path, by, part_name("b", batch_id), batch_id)


def live_parts(spark: SparkSession, folder: str) -> list[str]:
    """Names of the parts that count: the last whole merge, the batches after
    it, and repairs."""
    names = sorted(child_folders(spark, folder))
    merged = [n for n in names if n.startswith("part=m-") and path_exists(spark, f"{folder}/{n}/_SUCCESS")]
    last = merged[-1].split("-")[1] if merged else ""
    later = [n for n in names if n.startswith("part=b-") and n.split("-")[1] > last]
    return merged[-1:] + later + [n for n in names if n == REPAIR]


def groups(spark: SparkSession, path: str, by: str) -> list[str]:
    return sorted(n.split("=", 1)[1] for n in child_folders(spark, path) if n.startswith(f"{by}="))


def read_parts(spark: SparkSession, path: str, by: str, values: Iterable | None = None,
               repaired: bool = True) -> DataFrame | None:
    """Rows of the given groups (all if none are given), with ``by`` and
    ``batch_id``; None if they have no rows yet. Only folders of those groups
    are listed."""
    wanted = groups(spark, path, by) if values is None else [str(v) for v in values]
    paths = [f"{path}/{by}={v}/{p}" for v in wanted for p in live_parts(spark, f"{path}/{by}={v}")
             if repaired or p != REPAIR]
    return spark.read.option("basePath", path).parquet(*paths).drop("part") if paths else None


def merge_parts(spark: SparkSession, path: str, by: str, values: Iterable, every: int,
                resolve: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Merges each given group that has ``every`` batch parts or more."""
    for v in values:
        folder = f"{path}/{by}={v}"
        parts = [p for p in live_parts(spark, folder) if p != REPAIR]
        batches = [p for p in parts if p.startswith("part=b-")]
        if len(batches) < every:
            continue
        target = f"part=m-{batches[-1].split('-')[1]}"
        rows = spark.read.parquet(*[f"{folder}/{p}" for p in parts])
        resolve(rows).write.mode("overwrite").parquet(f"{folder}/{target}")
        if parts[0].startswith("part=m-"):
            for name in child_folders(spark, folder):
                if name not in (parts[0], REPAIR) and name.split("-")[-1] <= parts[0].split("-")[1]:
                    delete_path(spark, f"{folder}/{name}")
