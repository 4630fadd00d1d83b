"""Session helpers: pinned time zone, shared work folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "daypulse", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and scripts. On a cluster the master and the
    checkpoint folder come from the submit configuration, not from here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # commit only the changelog per batch; snapshots are made in the background
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Every day/hour key is computed in UTC (the reference used the JVM zone)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master gets a folder under
    /tmp; any other master is refused, because executors would write to disks
    that the others cannot read."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="daypulse-ckpt-", dir="/tmp")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir().rstrip("/")


def _work_root(spark: SparkSession) -> str:
    return "/".join([checkpoint_root(spark), "daypulse", spark.sparkContext.applicationId])


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (one per run, never reused)."""
    return "/".join([_work_root(spark), *parts, uuid.uuid4().hex])


def clear_work(spark: SparkSession) -> None:
    """Deletes what this application has written under the work folder. Results
    are lazy and read from there: call it once they have been stored."""
    delete_path(spark, _work_root(spark))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at ``path``. Asked of the store itself,
    so that a failed read is never taken for an empty table."""
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Name, length and time of the file at ``path`` or of those directly in it."""
    fs, p = _hadoop_path(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, none if it is missing."""
    fs, p = _hadoop_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []
