"""Token ids in files of fixed-width packed bits, with random access.

A file is Parquet, so that Spark's committer, any store and lost executors are
taken care of; a row of it is one block of consecutive documents:

    part, block       place of the block: range partition, then number
    width             bits per id, the fewest that hold the vocabulary
    doc_ids, lengths  documents of the block and their number of ids
    bits              all ids of the block, ``width`` bits each, high bit first
    first_in_part     ids of the part before this block
    n_ids             number of ids

Document k of a block starts at bit ``width * sum(lengths[:k])`` of ``bits``;
a block's first id in the corpus is ``first_in_part`` plus the ids of the parts
before (``part_starts``). Nothing else is needed to read any id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daypulse.llm.common import saved, shuffle_tasks
from daypulse.llm.tokens import encoder, tokenizer_path
from daypulse.session import work_path

END_ID = 2
BLOCK_IDS = 1 << 18

FILE_SCHEMA = ("part int, block int, width int, doc_ids array<bigint>, lengths array<bigint>, "
               "bits binary, first_in_part bigint, n_ids bigint")
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("width", pa.int32()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("bits", pa.binary()), ("first_in_part", pa.int64()), ("n_ids", pa.int64())])


def bit_width(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits of each id, high bit first; the last byte is filled with zeros."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if width == 16:
        return ids.astype(">u2").tobytes()
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((ids[:, None] >> shifts) & 1).astype(np.uint8)).tobytes()


def unpack(bits: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from the ``start``-th on, reading only their bytes."""
    if width == 16:
        return np.frombuffer(bits, ">u2", count, 2 * start).astype(np.uint32)
    first, last = start * width, (start + count) * width
    part = np.frombuffer(bits, np.uint8, (last + 7) // 8 - first // 8, first // 8)
    flat = np.unpackbits(part)[first % 8:first % 8 + count * width].reshape(count, width)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(width - 1, -1, -1, dtype=np.uint32))


def write_ids(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str,
              end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every text (null: empty), ends each document with ``end_id`` and
    writes blocks in ascending doc_id order (null ids first). A block closes at
    ``block_ids`` ids; a longer document is a block of its own. Rows that repeat
    a doc_id are written one after the other, by the hash of their texts. An empty table writes no block."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = bit_width(enc.vocab_size)
        part, number, before, names, held = 0, 0, 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal number, before, names, held
            ids = np.concatenate(held)
            row = [[part], [number], [width], [names], [[len(x) for x in held]],
                   [pack(ids, width)], [before], [len(ids)]]
            number, before, names, held = number + 1, before + len(ids), [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        count = 0
        for batch in batches:
            parts, docs_in, texts = (batch.column(k) for k in ("part", "doc_id", "text"))
            for p, name, text in zip(parts, docs_in, texts):
                part = p.as_py()
                names.append(name.as_py())
                held.append(np.append(enc.encode(text.as_py()), np.uint32(end_id)))
                count += len(held[-1])
                if count >= block_ids:
                    count = 0
                    yield close()
        if held:
            yield close()

    # the text's hash lets the ranges split a doc_id that repeats endlessly, and
    # gives its rows an order that a rerun keeps
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    ordered = (docs.select("doc_id", "text", body.alias("body"))
                   .repartitionByRange(shuffle_tasks(spark), "doc_id", "body")
                   .sortWithinPartitions("doc_id", "body").withColumn("part", F.spark_partition_id()))
    (ordered.select("part", "doc_id", "text").mapInArrow(blocks, FILE_SCHEMA)
            .write.option("compression", "none").parquet(path))


def part_starts(files: DataFrame) -> DataFrame:
    """``part, base``: ids in the parts before. One row per range partition, so
    the prefix sum over them is small at any size of the corpus."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


READ_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document read back from the files: place, length and crc32
    of its ids as little-endian 32-bit integers."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(unpack(r["bits"], r["width"], int(e - n), int(n))
                                   .astype("<u4").tobytes()) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["first_id"] + ends - lengths),
                     pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # written first: the planner sees its true size and leaves the bits in place
    starts = saved(spark, part_starts(files), "part-starts")
    return (files.join(starts, "part")
                 .select("width", "doc_ids", "lengths", "bits",
                         (F.col("base") + F.col("first_in_part")).alias("first_id"))
                 .mapInArrow(documents, READ_SCHEMA))


def op8_bit_packing(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = work_path(spark, "llm", "packed-ids")
    write_ids(spark, docs, path, tokenizer or tokenizer_path())
    return read_documents(spark, path)
