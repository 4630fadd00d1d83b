"""Keyed lookup tables (S8): the state or dimension table that a batch
probes, read from JDBC or Parquet, pruned to the keys of the batch.

The reference built an ``IN (...)`` list of the batch ids on the driver; here
the batch keys stay distributed and prune the table with a left-semi join
(AQE broadcasts the key side when it is small, and a partitioned Parquet
table gets dynamic partition pruning)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lookup(spark: SparkSession, *, path: str | None = None, url: str | None = None,
                query: str | None = None, table: str | None = None,
                properties: dict | None = None) -> DataFrame:
    """A lookup table from Parquet (``path``) or JDBC (``url`` with ``query``
    or ``table``). Unlike the reference's dynamic rows, the schema is fixed
    when the frame is built."""
    if path:
        return spark.read.parquet(path)
    if not url:
        raise ValueError("give path or url")
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query:
        return r.option("query", query).load()
    return r.option("dbtable", table).load()


def for_keys(lookup: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``lookup`` whose key occurs in ``keys``."""
    return lookup.join(keys.select(*on).distinct(), list(on), "left_semi")
