"""Tables that jobs keep up to date and queries only read: written once per
application and input, then read with their pruning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from daypulse.session import fingerprint, path_exists, work_path

_paths: dict[tuple, str] = {}


def derived(spark: SparkSession, sf_dir: str, name: str, inputs: Sequence[str],
            build: Callable[[str], None]) -> str:
    """Path of the table ``name`` made from the ``inputs``; ``build(path)`` writes
    it where it is missing: at first, when a file of an input has changed, or
    after ``session.clear_work``."""
    files = tuple(fingerprint(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in inputs)
    key = (spark.sparkContext.applicationId, name, sf_dir, files)
    path = _paths.get(key)
    if path is None or not path_exists(spark, path):
        path = work_path(spark, name)
        build(path)
        _paths[key] = path
    return path
