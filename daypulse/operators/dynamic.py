"""Logs as they are (§2.8 json, S8): fields that no schema declares.

A collector adds fields before anyone declares them. ``VARIANT`` keeps the whole
line in a binary form, so such a field can be listed, typed and read later
without a new parse or schema; a line that is no JSON gives a null document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_document(records: DataFrame, value: str = "value") -> DataFrame:
    """Records with their line as ``doc``, a VARIANT."""
    return records.withColumn("doc", F.try_parse_json(value))


def field(path: str, kind: str = "string") -> Column:
    """A field of ``doc`` by its path, null where it is missing or not of that kind."""
    return F.try_variant_get("doc", path, kind)


def fields(documents: DataFrame, depth: int = 2) -> DataFrame:
    """``path, value``: a row per field and document, objects opened ``depth``
    deep (``common``, ``common.mid``). Arrays are values, not opened."""
    spark = documents.sparkSession
    level = documents.select(F.lit("").alias("path"), F.col("doc").alias("v"))
    found = []
    for _ in range(depth):
        inside = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).where(F.col("key").isNotNull())
        name = F.when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
        level = inside.select(name.alias("path"), F.col("value").alias("v"))
        found.append(level.select("path", F.col("v").alias("value")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def declared_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths that a schema declares, nested ones included."""
    out = []
    for f in schema.fields:
        out.append(prefix + f.name)
        if isinstance(f.dataType, T.StructType):
            out += declared_paths(f.dataType, f"{prefix}{f.name}.")
    return out


def census(documents: DataFrame, declared: T.StructType, depth: int = 2) -> DataFrame:
    """``path, kind, declared, n``: every field that occurs, by the kinds it
    occurs in (an object is OBJECT, whatever is in it)."""
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    per = fields(documents, depth).groupBy("path", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("path").isin(declared_paths(declared))
    return per.select("path", "kind", known.alias("declared"), "n")


def shape(documents: DataFrame) -> DataFrame:
    """``shape``: one schema that all documents fit."""
    return documents.agg(F.schema_of_variant_agg("doc").alias("shape"))
