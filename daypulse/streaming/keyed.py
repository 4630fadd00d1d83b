"""Keyed state of the engine beside the rows that touch it.

A streaming aggregate keeps a value per key and, in update mode, gives the keys
that a micro-batch touched; only those are read from the state store. A sink
also needs the rows of that batch. Both come from one query: the rows and the
touched keys are two branches over the same source, so they carry the same
offsets and commit together, and a batch that is delivered again starts from the
state before it.

The state here is how many rows of a key were ever counted. A key is new exactly
if the batch holds all of them; no clock and no table of known keys is asked. A
key of the batch that comes without state is one that the watermark has closed:
the engine has dropped its rows as late. The aggregate combines before the
shuffle, so a key with a third of all rows costs its state task a row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that were ever counted, this batch included.
EVER = "n_ever"


def counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streaming state: ``keys`` and how many rows of each were ever seen."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(EVER))


def with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One stream of ``row`` (the rows themselves) and ``state`` (touched keys),
    the other null. To be written in update mode."""
    def none(of: DataFrame):
        return F.lit(None).cast(of.schema.simpleString())

    return rows.select(F.struct("*").alias("row"), none(state).alias("state")).unionByName(
        state.select(none(rows).alias("row"), F.struct("*").alias("state")))


def rows_of(batch: DataFrame) -> DataFrame:
    return batch.where(F.col("row").isNotNull()).select("row.*")


def touched_keys(batch: DataFrame) -> DataFrame:
    return batch.where(F.col("state").isNotNull()).select("state.*")
