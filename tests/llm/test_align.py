"""Tokenizer alignment against a token-by-token walk."""

import hashlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from daypulse.llm import align
from daypulse.llm.tokens import tokenizer_path
from tests.conftest import SF_SMALL

A, B = tokenizer_path(align.FILE_A), tokenizer_path(align.FILE_B)
SCHEMA = T.StructType([T.StructField(c, t) for c, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("a_ids", T.StringType()), ("doc", T.LongType()))])
EDGE = [(1, None), (2, ""), (3, " "), (4, "a"), (5, "  two  spaces "), (6, "▁sign"), (7, "</s> <s> <unk> <0x41>"),
        (8, "<|endoftext|> x"), (9, "tab\tline\n\n\r\nend\n"), (10, "naïve Ünï 日本語 🙂 ﬁ ​"), (11, "w" * 5000),
        (12, "don't we'll 12345 a_b-c"), (13, "a\u0000b"), (14, "word " * 3000), (9, "again"), (None, "no id"),
        (9, "again"), (15, " lead"), (16, "\n")]


def one_by_one(a, b, text):
    """Tokens of both sides with their ends, taken apart by decoding."""
    if not text:
        return None
    chars = align.byte_level()
    ids_a = a.encode(" " + text, add_special_tokens=False)
    ids_b = b.encode(text)
    bytes_a = [bytes(chars[c] for c in t) for t in ids_a.tokens]
    bytes_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        bytes_b.append(bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    return list(zip(ids_a.ids, bytes_a)), list(zip(ids_b, bytes_b))


def walk(left, right):
    """Groups of token numbers, and all overlapping pairs."""
    def ends(tokens):
        total, out = 0, []
        for _, x in tokens:
            out.append((total, total + len(x)))
            total += len(x)
        return out

    ea, eb = ends(left), ends(right)
    shared = sorted({e for _, e in ea} & {e for _, e in eb})
    groups, last = [], 0
    for cut in shared:
        groups.append(([i for i, (_, e) in enumerate(ea) if last < e <= cut],
                       [j for j, (_, e) in enumerate(eb) if last < e <= cut]))
        last = cut
    return groups, ea, eb


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tools, rows):
    docs, counts = [], Counter()
    for doc, text in rows:
        both = one_by_one(*tools, text)
        if both is None:
            docs.append((doc, 0, 0, [], []))
            continue
        left, right = both
        groups, _, _ = walk(left, right)
        links = [(left[g[-1]][0], right[h[-1]][0]) for g, h in groups]
        counts.update(links)
        docs.append((doc, len(left), len(right), links,
                     [([left[i][0] for i in g], [right[j][0] for j in h]) for g, h in groups]))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc, n_a, n_b, links, groups in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return Counter(out)


def test_edges(spark, tools):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in EDGE], SCHEMA)
    got = align.op13_tokenizer_alignment(spark, df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(tools, EDGE)


def test_documents(spark, tools):
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    rows = [(i, t) for i, t in zip(rows["doc_id"], rows["text"]) if len(t or "") < 3000]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA).repartition(3)
    assert Counter(map(tuple, align.op13_tokenizer_alignment(spark, df).collect())) == brute(tools, rows)


def test_empty_table(spark):
    assert align.op13_tokenizer_alignment(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_overlaps_and_spans(spark, tools):
    text = "Überlappung of sub-tokens, naïve 日本 end"
    df = spark.createDataFrame([(1, text, "x", 0), (2, None, "x", 0)], SCHEMA).coalesce(1)
    row, empty = align.align(df, A, B, with_overlaps=True).collect()
    left, right = one_by_one(*tools, text)
    groups, ea, eb = walk(left, right)
    assert row.a_ids == [i for i, _ in left] and row.b_ids == [i for i, _ in right]
    assert row.a_upto == [g[-1] + 1 for g, _ in groups] and row.b_upto == [h[-1] + 1 for _, h in groups]
    want = {(i, j) for i, (s, e) in enumerate(ea) for j, (p, q) in enumerate(eb) if s < q and p < e}
    pairs = list(zip(row.over_a, row.over_b))
    assert set(pairs) == want and len(pairs) == len(want)
    assert empty.a_ids == empty.b_upto == empty.over_a == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab éß\n\t  '.0🙂▁ſ<|>ſś")), max_size=40))
def test_encoding_equals_the_tokenizers(text):
    encoder = align.tokenizers(A, B).a
    assert encoder.fast is not None
    ids = encoder.encode(" " + text)
    assert ids == encoder.tokenizer.encode(" " + text, add_special_tokens=False).ids
    assert encoder.decode(ids) == " " + text


def test_pairs_hold_every_link(tools):
    tok = align.tokenizers(A, B)
    numbers, b_of = tok.pairs()
    assert (numbers[1:] > numbers[:-1]).all() and len(numbers) < 1_000_000
    for text in (t for _, t in EDGE):
        both = one_by_one(*tools, text)
        if both:
            left, right = both
            for g, h in walk(left, right)[0]:
                number = left[g[-1]][0] * len(tok.b_bytes) + right[h[-1]][0]
                at = numbers.searchsorted(number)
                assert numbers[at] == number and b_of[at] == right[h[-1]][0]
