"""Quality rules kept as a ledger of failure bits and measurements."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import saved

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_ASCII_UPPER = bytes(range(65, 91))
#: Upper case of Latin-1 (U+00C0 to U+00DE without the multiplication sign), in UTF-8.
_LATIN_UPPER = re.compile(rb"\xc3[\x80-\x96\x98-\x9e]")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")

#: Rules by bit: name and the condition under which a document fails.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("upper_case", "100 * n_upper > 40 * word_chars"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("long_words", "word_chars > 25 * n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": ("few_words", "repeated_windows", "symbols", "upper_case"),
    "strict": ("few_words", "repeated_windows", "symbols", "upper_case", "duplicate_lines", "long_words"),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words found twice or more in the text."""
    windows = list(zip(*(words[k:] for k in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.fromiter((k for k, w in enumerate(windows) if seen[w] > 1), np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of a text; null is no text. Lines count if they hold a word."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six SPACES
    spaces = len(raw) - len(raw.translate(None, SPACES))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = (len(raw) - len(raw.translate(None, _ASCII_UPPER))
             + (len(_LATIN_UPPER.findall(raw)) if b"\xc3" in raw else 0))
    return (len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words), upper)


LEDGER_SCHEMA = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)


def failure_bits() -> Column:
    """One pass over the rules: bit k is set where rule k fails."""
    bits = F.lit(0)
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)))
    return bits.cast("int")


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``bits`` of every row: each rule is
    evaluated once here, and any policy is later a mask over the bits. Null and
    empty texts measure zero everywhere; repeated rows stay repeated."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column("text")]
            columns = list(zip(*rows)) or [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", *MEASURES])

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, LEDGER_SCHEMA)
                .withColumn("bits", failure_bits()))


def apply_policy(kept_ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    return kept_ledger.withColumn("kept", F.col("bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(kept_ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (they
    would return without it), and all that the policy rejects. The ledger first
    shrinks to one row per distinct bits."""
    full = mask(policy)
    by_bits = kept_ledger.groupBy(F.col("bits").bitwiseAND(F.lit(full)).alias("bits")).agg(
        F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).alias("bit"))
                      for name in POLICIES[policy]])
    one = by_bits.withColumn("r", F.explode(rules))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return one.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"))


def judge(spark: SparkSession, docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger of ``docs``, written once and read back, with the verdict of a
    policy: ``kept``, ``reasons`` (the bits of its rules that failed) and
    ``n_alone`` (where one rule alone rejects the row: how many rows return if
    the policy drops that rule, from the ablation; else null)."""
    held = saved(spark, ledger(docs), "quality-ledger")
    # one row per rule
    returns = ablation(held, policy).select(
        F.element_at(F.create_map(*[x for n, bit in BIT.items() for x in (F.lit(n), F.lit(bit))]), F.col("rule")
                     ).alias("reasons"), F.col("n_only").cast("long").alias("n_alone"))
    judged = apply_policy(held, policy).withColumn("reasons", F.col("bits").bitwiseAND(F.lit(mask(policy))))
    return judged.join(F.broadcast(returns), "reasons", "left")


def op6_quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    base = F.col("bits").bitwiseAND(F.lit(mask("base"))) != 0
    return judge(spark, docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        "kept", "reasons", "n_alone")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')))::BIGINT AS n_upper
  FROM d),
l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
  FROM rep, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
j AS (
  SELECT m.*, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM m LEFT JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
    + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_upper > 40 * word_chars)::INT AS INTEGER) AS reasons
  FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_upper > 40 * word_chars) AS kept, reasons,
  CASE WHEN reasons IN (1, 2, 4, 8) THEN count(*) OVER (PARTITION BY reasons) END AS n_alone
FROM b
"""
