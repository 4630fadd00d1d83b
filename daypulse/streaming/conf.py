"""Settings that a stream fixes at its first start.

The number of state partitions is taken from ``spark.sql.shuffle.partitions``
when a stateful stream first starts and is then kept in its checkpoint for ever;
the state store provider likewise. Every stream gets a session of its own for
them, so that neither the caller nor another stream sees a change."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from daypulse.session import pin_session

SHUFFLE, ADAPTIVE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"
#: The caller's shuffle partitions, for what a batch does beside its state.
BATCH_TASKS = "daypulse.batch.tasks"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of the same application for one stream. ``state_partitions`` is
    the number of tasks its state is kept in for as long as its checkpoint
    lives: choose it for the cluster the stream will grow to, not for the
    executors that happen to be up."""
    own = pin_session(spark.newSession())
    own.conf.set(BATCH_TASKS, str(max(state_partitions, int(spark.conf.get(SHUFFLE)))))
    own.conf.set(SHUFFLE, str(state_partitions))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


@contextmanager
def batch_settings(spark: SparkSession) -> Iterator[None]:
    """Within a foreachBatch body: joins and writes of the batch (``spark`` is the
    batch's session) run adaptively and in the caller's number of tasks, not in
    the few that the state is kept in. The state of the batch is planned before
    and that of the next one after, with the settings put back."""
    before = {k: spark.conf.get(k) for k in (SHUFFLE, ADAPTIVE)}
    spark.conf.set(SHUFFLE, spark.conf.get(BATCH_TASKS, before[SHUFFLE]))
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
