"""File-stream twin of a topic: records land in one folder per arrival
window, written in window order, so file modification times rise with
arrival as a broker's log would. A stream reads the landing folder with the
Kafka record schema; ``read_records`` in ``sources.kafka`` yields the same
columns from a real topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.schemas import RECORD
from daypulse.session import child_folders, fingerprint, work_path


def arrival_window(ts_col: str, window_ms: int):
    return F.floor(F.unix_millis(F.col(ts_col)) / F.lit(window_ms)).cast("long")


#: A landed file holds about so many bytes, and is written by one task.
FILE_BYTES = 64 * 1024 * 1024


def land_windows(spark: SparkSession, records: DataFrame, landing: str, window_ms: int,
                 file_bytes: int = FILE_BYTES) -> int:
    """Writes ``records`` window by window and returns how many files each window
    has: so many that none has much more than ``file_bytes``. The feed is computed
    once, split by window on the cluster; each window is then read from its own
    folder, so the work follows the data, not data times windows.

    Every window gets the same number of files, so that a stream that takes so
    many per trigger takes a window per micro-batch: one that has fewer is filled
    up with files of one empty record each, which ``stream_records`` skips."""
    staged = work_path(spark, "staged")
    cols = RECORD.fieldNames()
    (records.select(*cols, arrival_window("timestamp", window_ms).alias("window"))
     .write.partitionBy("window").parquet(staged))
    windows = sorted(int(n.split("=")[1]) for n in child_folders(spark, staged) if n.startswith("window="))
    sizes = [sum(n for _, n, _ in fingerprint(spark, f"{staged}/window={w}")) for w in windows]
    files = max([1, *(-(-size // file_bytes) for size in sizes)])
    for k, w in enumerate(windows):
        folder = f"{landing}/window-{k:012d}"
        (spark.read.schema(RECORD).parquet(f"{staged}/window={w}").coalesce(files)
         .write.parquet(folder))
        missing = files - sum(name.startswith("part-") for name, _, _ in fingerprint(spark, folder))
        if missing:
            (spark.range(0, missing, 1, missing).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD])
             .write.mode("append").parquet(folder))
    return files


def stream_records(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Streaming frame over every window folder under ``landing``, without the
    empty records that fill up a window (no record is without a topic)."""
    r = spark.readStream.schema(RECORD)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{landing}/*").where(F.col("topic").isNotNull())
