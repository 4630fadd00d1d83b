"""The document operators against brute force written apart from them."""

import binascii
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import types as T
from tokenizers import Tokenizer

from daypulse.llm import bitpack, exact_dedup, mixing, packing, quality, sharding, simhash
from daypulse.llm.tokens import tokenizer_path
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

EDGE = [(1, "one two  three"), (2, "one two three\n"), (3, None), (4, ""), (5, " \t\r\n"),
        (6, "onetwothree"), (7, "İ ÀÉ don't́ <|endoftext|> x y"), (8, "a " * 9000),
        (9, "one two  three"), (9, "one two  three"), (None, "no id"), (10, "w" * 30000),
        (11, "\x1c a\x85b \x1f")]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, None if (i or 0) % 3 == 0 else f"s{(i or 0) % 3}", 0) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def small():
    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def inputs(spark, docs, small):
    yield docs, list(zip(small["doc_id"], small["text"]))
    yield frame(spark, EDGE), EDGE
    yield frame(spark, []), []


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup(spark, docs, small):
    for df, rows in inputs(spark, docs, small):
        groups = defaultdict(list)
        for i, t in rows:
            groups[bare(t)].append((-len(t or ""), i is None, i or 0))
        got = exact_dedup.op4_exact_dedup(spark, df).collect()
        assert len(got) == len(rows)
        assert sum(r.kept for r in got) == len(groups)
        by = defaultdict(list)
        for r in got:
            by[r.text_sha256].append(r)
        for text, members in groups.items():
            mine = by[hashlib.sha256(text.encode()).hexdigest()]
            best = min(members)
            assert {r.keep_id for r in mine} == {None if best[1] else best[2]}
            assert {r.group_size for r in mine} == {len(members)} and len(mine) == len(members)


def test_exact_dedup_filter_keeps_columns(spark):
    df = frame(spark, EDGE)
    out = exact_dedup.keep_one(spark, df)
    assert out.columns == df.columns
    assert sorted(bare(r.text) for r in out.collect()) == sorted({bare(t) for _, t in EDGE})


def test_perfect_hash_is_minimal_and_checked():
    rng = np.random.default_rng(0)
    digests = rng.integers(0, 256, (20_000, 32), np.uint8)
    digests[1, 8:24] = digests[0, 8:24]  # equal in the hashed half, apart in full
    levels, slot = exact_dedup.build_slots(digests)
    assert sorted(slot) == list(range(len(digests)))
    table = digests[np.argsort(slot)]
    levels = exact_dedup._unpack(exact_dedup._pack(levels))
    assert (exact_dedup.find_slots(levels, table, digests) == slot).all()
    others = rng.integers(0, 256, (20_000, 32), np.uint8)
    assert (exact_dedup.find_slots(levels, table, others) == -1).all()


def slow_fingerprint(text):
    words = WORDS.findall((text or ""))
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    parts = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, fps):
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                label[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [least.get(root(k)) for k in range(len(rows))]


def test_simhash(spark, docs, small):
    for df, rows in inputs(spark, docs, small):
        fps = [slow_fingerprint(t) for _, t in rows]
        want = sorted(zip([i is None for i, _ in rows], [i or 0 for i, _ in rows],
                          [f"{f:016x}" for f in fps], [str(c) for c in slow_components(rows, fps)]))
        got = simhash.op5_simhash(spark, df).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, str(r.component_id))
                      for r in got) == want


def test_vantage_point_tree_finds_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 64, 3000, np.uint64)
    near = base[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    near = np.concatenate([near, near[:700] ^ np.uint64(6)])
    points = np.unique(np.concatenate([base, near, np.arange(200, dtype=np.uint64)]))
    label = simhash.link_points(points, 2)
    whole = simhash.Links(len(points))
    for k in range(len(points)):
        b = np.flatnonzero(np.bitwise_count(points ^ points[k]) <= 2)
        whole.add(np.full(len(b), k), b)
    assert (label == whole.label).all()
    # shards of the top tree hold every pair whole
    tree = simhash.top_tree(points[::3], len(points), 2, 300)
    pairs = set()
    for _, here in simhash.route(tree, points, 2):
        near = np.bitwise_count(here[:, None] ^ here[None, :]) <= 2
        pairs |= {(int(here[a]), int(here[b])) for a, b in zip(*np.nonzero(near))}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    assert pairs == {(int(points[a]), int(points[b])) for a, b in zip(*np.nonzero(near))}
    assert tree is not None


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (102, 101)], "a long, b long")
    got = {r.node: r.label for r in simhash.components(spark, links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


def test_simhash_filter_keeps_one_per_component(spark, docs, small):
    out = simhash.keep_one(spark, docs)
    rows = list(zip(small["doc_id"], small["text"]))
    want = set(slow_components(rows, [slow_fingerprint(t) for _, t in rows]))
    assert sorted(r.doc_id for r in out.collect()) == sorted(want) and out.columns == docs.columns


def slow_measures(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    count = Counter(windows)
    cover = {k + o for k, w in enumerate(windows) if count[w] > 1 for o in range(5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(cover))


def test_quality_measures(spark, docs, small):
    for df, rows in inputs(spark, docs, small):
        got = quality.op6_quality_rules(spark, df).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                       r.n_repeat_words) for r in got) == sorted(
            (i is None, i or 0, *slow_measures(t)) for i, t in rows)
        assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
                   and not (r.kept and r.base_failed) for r in got)


def test_quality_ablation_counts_single_reasons(spark):
    texts = ["a b", "x " * 30, " ".join(f"w{k}" for k in range(20)), " ".join(f"w{k}%" for k in range(20))]
    got = {r.rule: r for r in quality.ablation(quality.ledger(frame(spark, list(enumerate(texts))))).collect()}
    assert (got["few_words"].n_failed, got["few_words"].n_only) == (1, 1)
    assert (got["repeated_windows"].n_only, got["symbols"].n_only) == (1, 1)
    assert {r.n_rejected for r in got.values()} == {3}


def test_quality_ledger_serves_other_policies(spark):
    texts = ["a b", "x " * 30, " ".join(f"w{k}" for k in range(20)), " ".join(f"w{k}%" for k in range(20)),
             " ".join(f"W{k}X" for k in range(20)), "c d", "% %"]
    df = frame(spark, list(enumerate(texts)))
    got = {r.doc_id: (r.kept, r.reasons, r.n_alone) for r in quality.judge(spark, df).collect()}
    assert got == {0: (False, 1, 2), 1: (False, 2, 1), 2: (True, 0, None), 3: (False, 4, 1), 4: (False, 8, 1),
                   5: (False, 1, 2), 6: (False, 5, None)}
    v1 = {r.doc_id: (r.kept, r.reasons) for r in quality.judge(spark, df, "v1").collect()}
    assert v1[4] == (True, 0) and v1[3] == (False, 4)


def test_quality_agrees_with_labels(spark, docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    both = quality.op6_quality_rules(spark, docs).join(labels, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in both) >= 0.85 * len(both)


def test_sharding_by_rows(spark, docs, small):
    many = [(k, "copy" if k % 3 == 0 else f"pair {k // 2}" if k % 3 == 1 else f"own {k}") for k in range(900)]
    for df, rows in [*inputs(spark, docs, small), (frame(spark, many), many)]:
        got = sharding.op7_balanced_sharding(spark, df).collect()
        count = Counter(r.shard for r in got)
        assert len(got) == len(rows)
        sizes = [count.get(s, 0) for s in range(40)]
        assert max(sizes) - min(sizes) <= 1
        for s in count:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
        want = Counter((i, len((t or "").encode()) + 16, binascii.crc32((t or "").encode())) for i, t in rows)
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_sharding_cuts_few_links(spark, docs, small):
    many = [(k, f"pair {k // 2}" if k < 800 else f"own {k}") for k in range(1600)]
    df = frame(spark, many)
    moved = sharding.shard(spark, df)
    cut = sum(r.cut for r in sharding.cut_links(moved).collect())
    assert cut <= 20  # of 400 links; a random split cuts 390


def test_sharding_exchanges_rows_between_full_shards(spark):
    moved = sharding.shard(spark, frame(spark, [(k, f"pair {k // 2}") for k in range(4000)]))
    assert sum(r.cut for r in sharding.cut_links(moved).collect()) <= 100  # of 2000 links; all rows are linked


def test_sharding_fills_as_few_shards_as_a_large_group_needs(spark):
    for rest in ("own {}", "pair {}"):
        rows = [(k, "copy" if k % 3 == 0 else rest.format(k // 6 * 2 + k % 3)) for k in range(3000)]
        moved = sharding.shard(spark, frame(spark, rows)).where("text_crc32 = %d" % binascii.crc32(b"copy"))
        assert moved.select("shard").distinct().count() <= 15  # 14 hold it


def test_served_moves_rings_and_keeps_to_the_room():
    ring = np.array([[0, 5, 0], [0, 0, 4], [6, 0, 0]])
    assert (sharding.served(ring, [0, 0, 0]) == np.where(ring > 0, 4, 0)).all()
    rng = np.random.default_rng(3)
    for _ in range(20):
        asked = rng.integers(0, 9, (12, 12)) * (rng.random((12, 12)) < 0.4)
        np.fill_diagonal(asked, 0)
        room = rng.integers(0, 5, 12)
        got = sharding.served(asked, room)
        assert (got >= 0).all() and (got <= asked).all()
        assert (got.sum(axis=0) - got.sum(axis=1) <= room).all()


def slow_ids(texts, end):
    t = Tokenizer.from_file(tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


def crc(ids):
    return binascii.crc32(np.array(ids, "<u4").tobytes())


def test_bit_packing(spark, docs, small):
    for df, rows in inputs(spark, docs, small):
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        want, start = [], 0
        for (i, _), ids in zip(rows, slow_ids([t for _, t in rows], 2)):
            want.append((start, i, len(ids), crc(ids)))
            start += len(ids)
        got = bitpack.op8_bit_packing(spark, df).collect()
        assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want


@pytest.mark.parametrize("width", [1, 5, 15, 16, 17, 20])
def test_bit_width_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001).astype(np.uint32)
    bits = bitpack.pack(ids, width)
    assert len(bits) == (width * 1001 + 7) // 8
    assert (bitpack.unpack(bits, width, 0, 1001) == ids).all()
    assert (bitpack.unpack(bits, width, 333, 77) == ids[333:410]).all()


def test_packing(spark, docs, small):
    for df, rows in inputs(spark, docs, small):
        want = Counter()
        total = 0
        for (i, _), ids in zip(rows, slow_ids([t for _, t in rows], 1)):
            total += len(ids)
            for k in range(0, len(ids), 4096):
                want[i, k // 4096, k, len(ids[k:k + 4096]), crc(ids[k:k + 4096])] += 1
        got = packing.op10_best_fit_packing(spark, df).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for s in sequences.values():
            end = 0
            for offset, length in sorted(s):
                assert offset == end
                end += length
            assert end <= 4096
        assert len(sequences) <= -(-total // 4096) + 1


def test_packed_sequences_hold_all_ids(spark, docs, small):
    texts = dict(zip(small["doc_id"], small["text"]))
    for df, want in ((docs, texts), (docs.where("doc_id < 40").unionAll(docs.where("doc_id < 40")), None)):
        packed = packing.pack_documents(spark, df).collect()
        got = {r.sequence_id: r.ids for r in packing.sequences(df, spark.createDataFrame(packed)).collect()}
        rows = defaultdict(list)
        for r in packed:
            ids = got[r.sequence_id][r.offset:r.offset + r.length]
            assert crc(ids) == r.ids_crc32
            rows[r.sequence_id].append(r.length)
        assert {k: sum(v) for k, v in rows.items()} == {k: len(v) for k, v in got.items()}
        assert all(len(v) <= 4096 for v in got.values())


def test_patterns_use_up_any_stock():
    rng = np.random.default_rng(3)
    for capacity in (7, 20, 100):
        for _ in range(40):
            items = Counter(rng.integers(1, capacity + 1, rng.integers(0, 60)).tolist())
            used = Counter()
            for lengths, n in packing.plan(items, capacity):
                assert sum(lengths) <= capacity
                used.update({x: n * k for x, k in Counter(lengths).items()})
            assert used == items


def fewest(items, capacity):
    """Optimal number of bins by search over which items open and fill a bin."""
    best = [len(items)]

    def go(left, bins):
        if bins + -(-sum(left) // capacity) >= best[0] and left:
            return
        if not left:
            best[0] = min(best[0], bins)
            return
        first, rest = left[0], left[1:]

        def fill(k, room, chosen):
            go([x for j, x in enumerate(rest) if j not in chosen], bins + 1)
            seen = set()
            for j in range(k, len(rest)):
                if rest[j] <= room and rest[j] not in seen:
                    seen.add(rest[j])
                    fill(j + 1, room - rest[j], chosen | {j})
        fill(0, capacity - first, frozenset())
    go(sorted(items, reverse=True), 0)
    return best[0]


def test_reduction_never_costs_a_sequence():
    rng = np.random.default_rng(4)
    for _ in range(60):
        items = rng.integers(3, 20, 9).tolist()
        stock = packing.Stock(Counter(items), 20)
        fixed = packing.reduce_dominated(stock)
        left = [int(x) for x in stock.lengths() for _ in range(stock.left[x])]
        assert sum(n for _, n in fixed) + (fewest(left, 20) if left else 0) == fewest(items, 20)


def test_mix_rows_match_the_plan(spark, docs):
    taken = {r.doc_id: r for r in mixing.op9_mix_sources(spark, docs).collect()}
    out = mixing.mix(spark, docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(WORDS.findall(r.text or ""))
    assert all(words[i] == r.taken and r.taken <= 3 * r.size for i, r in taken.items())


def test_targets_reshare_the_excess(spark):
    rows = [("a", "w " * 10), ("b", "w " * 500), (None, "w " * 30), ("c", None)]
    df = spark.createDataFrame([(k, t, "x", s, 0) for k, (s, t) in enumerate(rows)], SCHEMA)
    got = {r.source: r for r in mixing.source_rates(df).collect()}
    # a, b, c, null weigh 1, 2, 3, 1: c holds no word; null stops at 90, a at 30
    assert got["c"].target == 0 and got[None].target == 90 and got["a"].target == 30
    assert got["b"].target == 420
    assert mixing.source_rates(frame(spark, [])).collect() == []
    assert mixing.op9_mix_sources(spark, frame(spark, [])).collect() == []


def test_exact_dedup_spreads_a_hot_text_and_only_the_index_decides(spark, monkeypatch):
    # a third of all rows is one text, most of those without an id
    rows = [(None if k % 3 == 0 and k % 2 else k, "same  text" if k % 3 == 0 else f"text {k % 700}") for k in range(3000)]
    got = exact_dedup.dedup(spark, frame(spark, rows)).collect()
    hot = [r for r in got if r.group_size == 1000]
    assert len(got) == 3000 and len(hot) == 1000 and {r.keep_id for r in hot} == {0}
    assert sum(r.kept for r in got) == len({bare(t) for _, t in rows})
    docs = exact_dedup.digested(frame(spark, rows)).checkpoint()
    history = exact_dedup.recorded(docs).where("group_size > 1")
    hot = history.where("group_size = 1000").selectExpr("digest", "true AS hot").checkpoint()
    index = exact_dedup.build_index(history, 3, hot)
    assert {r.shard for r in index.select("shard").collect()} == {*range(-exact_dedup.PARTS, 0), 0, 1, 2}
    found = exact_dedup.look_up(index, 3, docs, hot)
    assert found.where("member").count() == sum(r.group_size > 1 for r in got)
    nothing = exact_dedup.look_up(index.limit(0), 3, docs, hot)
    assert nothing.where("winner <> place OR group_size > 1 OR member").count() == 0    # without it nothing is removed


def test_rows_without_ids_draw_for_themselves(spark):
    rows = [(None if k % 3 == 0 else k, f"w{k} " * 5) for k in range(3000)]
    df = spark.createDataFrame([(i, t, None, "ab"[k % 2], 0) for k, (i, t) in enumerate(rows)], SCHEMA)
    got = mixing.op9_mix_sources(spark, df).groupBy("source_size", "target").sum("taken").collect()
    assert got and all(abs(r["sum(taken)"] - r.target) < 0.06 * r.target for r in got)


def test_rows_of_one_id_are_packed_in_a_fixed_order(spark):
    rows = [(7, f"text {k}") for k in range(300)] + [(None, f"none {k}") for k in range(300)]
    one, two = ([tuple(r) for r in bitpack.op8_bit_packing(spark, frame(spark, rows).repartition(n)).orderBy("start").collect()]
                for n in (2, 5))
    assert one == two and len(one) == 600
