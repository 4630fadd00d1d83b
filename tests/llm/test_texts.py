"""Chat formatting, substring dedup, toxicity and the pipeline."""

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from daypulse.llm import chat, mixing, packing, substring, toxicity
from daypulse.llm.queries import ORACLE, QUERIES
from daypulse.llm.tokens import tokenizer_path
from scripts.check_oracle import digest
from tests.conftest import SF_SMALL
from tests.llm.test_documents import EDGE, WORDS, frame, slow_components, slow_fingerprint

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_every_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {"pipeline"} | set(QUERIES) <= names and set(ORACLE) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))


def test_an_error_inside_the_subpackage_is_raised(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("daypulse.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    with pytest.raises(ModuleNotFoundError):
        E.queries()


# -- chat ----------------------------------------------------------------------

def test_escape_is_exact():
    rng = random.Random(1)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<s>", "|im_start|>", "x", " "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not re.search(r"</?s>|\[/?INST\]|<\|im_start\|>", hidden)


def test_chat_turns(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "<s>é\U0001f600"), (1, 2, "assistant", "ok </s> [\\INST]"),
            (1, 2, "assistant", "ok </s> [\\INST]"), (2, 0, None, None), (None, 0, "assistant", "a"),
            (3, 0, "assistant", "long " * 5000), (4, None, "user", "")]
    path = tokenizer_path(chat.TOKENIZER_FILE)
    turns = chat.format_turns(spark, spark.createDataFrame(rows, TURNS), path).collect()
    form = chat.Template(path)
    held = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.conv_id is None, r.conv_id or 0, r.nth)):
        held[r.conv_id].append(r)
    for conv, mine in held.items():
        want = [(a or "", t or "") for c, _, a, t in rows if c == conv]
        ids = [x for r in mine for x in r.ids]
        mask = chat.loss_mask(len(ids), [(r.loss_start, r.loss_end) for r in mine])
        place = 0
        for r, (role, text) in zip(mine, want):
            assert r.first_id == place
            mine_ids, mine_mask = np.array(r.ids), mask[place:place + len(r.ids)]
            shown = f"<s>{chat.escape(role)}[INST]{chat.escape(text)}[/INST]</s>"
            assert form.render(mine_ids) == shown
            assert form.read(mine_ids, mine_mask) == (role, text, text if role == "assistant" else "", len(shown))
            part = mine_mask.copy()
            part[:3] = 0    # a mask over part of a text gives that part
            inside = mine_ids[part > 0].tolist()
            assert form.read(mine_ids, part).trained == chat.unescape(form.encoder.decode(inside))
            place += len(r.ids)
    assert chat.read_back(chat.format_turns(spark, spark.createDataFrame([], TURNS), path), path).collect() == []


# -- substring dedup -------------------------------------------------------------

def slow_cut(rows):
    """doc_id -> words, removed flags; ids are distinct."""
    first = {}
    words = {i: WORDS.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out[i] = (w, gone)
    return out


def check_cut(got, rows):
    want = slow_cut(rows)
    assert len(got) == len(rows)
    for r in got:
        w, gone = want[r.doc_id]
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        assert r.kept_text == kept and r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        assert [k for s in r.spans for k in range(s.start, s.stop)] == [k for k, g in enumerate(gone) if g]
        assert all(s.stop - s.start >= 13 for s in r.spans)


@pytest.mark.parametrize("chunk", [1 << 24, 700])
def test_substring_dedup_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk)
    rng = random.Random(2)
    passages = [" ".join(f"p{p}.{k}" for k in range(n)) for p, n in enumerate((12, 13, 14, 30, 60))]
    rows = []
    for i in range(120):
        parts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(25))) for _ in range(4)]
        rows.append((i, "\n".join(x for pair in zip(parts, [rng.choice(passages) for _ in range(4)]) for x in pair)))
    rows += [(200 + k, rows[k * 3][1]) for k in range(20)] + [(300, None), (301, " \t"), (302, "same " * 40),
                                                             (303, "same " * 20), (304, "same " * 3000)]
    check_cut(substring.remove_repeats(spark, frame(spark, rows)).collect(), rows)


def test_substring_dedup_edges(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "w " * 50), (2, "w " * 50), (3, "w " * 13)]
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(spark, frame(spark, rows)).collect()}
    assert got == {(1, 2, 0), (None, 50, 0), (2, 50, 0), (3, 13, 13)}
    assert substring.remove_repeats(spark, frame(spark, [])).collect() == []


def test_a_hot_passage_does_not_meet_in_one_bucket(spark):
    text = " ".join(f"w{k}" for k in range(13))  # one window, one anchor
    df = frame(spark, [(k, text) for k in range(800)]).coalesce(1)
    one_place = np.zeros(1, np.int32).tobytes()
    seeds = df.select("doc_id", "text", F.lit(one_place).alias("places"))
    for rows in (substring.seed_rows(df, 8, 13, 5), substring.window_rows(seeds, 8, 13, 5)):
        held = Counter()
        for r in rows.collect():
            held[r.bucket] += int(np.frombuffer(r.runs, np.uint32).sum())
        assert max(held.values()) < 200 and sum(held.values()) in (800, 801)
    check_cut(substring.remove_repeats(spark, df).collect(), [(k, text) for k in range(800)])


def test_windows_have_anchors_in_common():
    rng = np.random.default_rng(5)
    for _ in range(50):
        passage = rng.integers(0, 2 ** 64, 13, np.uint64)
        sides = [rng.integers(0, 2 ** 64, n, np.uint64) for n in (20, 7, 3, 40)]
        a, b = np.concatenate([sides[0], passage, sides[1]]), np.concatenate([sides[2], passage, sides[3]])
        assert substring.anchors(a, 13, 5)[0][20] - 20 == substring.anchors(b, 13, 5)[0][3] - 3


# -- toxicity ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return toxicity.fit(spark, docs, labels)


@pytest.mark.parametrize("text,word", [
    ("you 1d10t", "idiot"), ("a m0r0n!", "moron"), ("5cum", "scum"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"),
    ("iiiidiooooot", "idiot"), ("tr@sh", "trash"), ("p a t h e t i c person", "pathetic"), ("cl0wn", "clown"),
    ("M-O-R-O-N", "moron"), ("5tup1d", "stupid"), ("ID10T", "idiot"), ("st*pid", "stupid")])
def test_disguises_are_decoded(model, text, word):
    restored = toxicity.restore(text, model.decoder)
    assert word in restored.split() or word + "!" in restored.split()
    assert model.score(text) >= 0.7


@pytest.mark.parametrize("text", ["iddiott", "mmoronn", "w0rthle$$", "so sstupid", "loooser", "5-c-u-m"])
def test_repeats_and_marks_still_score(model, text):
    assert model.score(text) >= 0.7


@pytest.mark.parametrize("text", [
    "m   o   r   o   n", "m\to\tr\to\tn", "i\nd\ni\no\nt", "i, d, i, o, t", "mo ro n", "id iot", "ídíót", "í d í ó t",
    "ｉｄｉｏｔ", "іdіоt", "m 0 r 0 n", "you are a stu pid one", "mo\u200bron", "l - o - s - e - r"])
def test_scattered_and_foreign_letters_score(model, text):
    assert model.score(text) >= 0.7


@pytest.mark.parametrize("text", ["the and of to in", "an id ea is it", "idiom ot", "so me on e", "los angeles er", "mor tal on"])
def test_short_words_stay_words(model, text):
    assert model.score(text) < 0.7


@pytest.mark.parametrize("token", ["1d10t", "m-o", "aab", "s*um", "$!ck", "a.b", "l00ser", "x__y", "!!", "(1t", "ß1é"])
def test_decoding_equals_the_cheapest_of_all_readings(model, token):
    """Every path of the lattice, enumerated."""
    dec = model.decoder

    def cost(path):
        a, b, total, text = 0, 0, 0.0, ""
        for out, extra in path:
            total += extra
            if out == " ":
                if not b:
                    return math.inf, ""
                total += dec.cost[a][b][0]
                a, b = 0, 0
            elif out:
                s = toxicity.symbol(out)
                total += dec.cost[a][b][s]
                a, b = b, s
            text += out
        return total + (dec.cost[a][b][0] if b else 0.0), text

    paths = [cost(p) for p in itertools.product(*(dec.options(token, k) for k in range(len(token))))]
    best = min(c for c, _ in paths)
    assert dec.decode(token) in {t.strip() for c, t in paths if c <= best + 1e-9}


def test_the_bound_holds_for_rows_of_one_id(spark):
    rows = [(7, f"text number {k} of one document " + " ".join(f"w{k}x{j}" for j in range(8))) for k in range(3000)]
    labels = spark.createDataFrame([(7, 1)], "doc_id long, toxic int")
    assert zlib.crc32(b"7") % 3 != 1
    assert toxicity.training_rows(spark, frame(spark, rows), labels, 100).count() == 100


@pytest.mark.parametrize("text", ["", None, "the and of", "call 555-0100 or a@b.c", "v1.2.3 x86_64", "12 + 3 = 15",
                                  "x " * 5000, "1" * 9000, "a b c d e f g"])
def test_clean_texts_pass(model, text):
    assert 0 <= model.score(text) < 0.7


def test_restored_texts(spark, model):
    df = frame(spark, [(1, "You 1d10t, go"), (2, None), (3, "fine text")])
    got = {r.doc_id: r.restored for r in toxicity.restored(df, model).collect()}
    assert got == {1: "you idiot, go", 2: "", 3: "fine text"}


def test_only_copies_leave_the_training_rows(spark):
    def text(k):
        return " ".join(["from the desk of someone", *(f"w{k}x{j}" for j in range(40)), "all rights reserved by them"])

    rows = [(k, text(k // 2 if k < 60 else k)) for k in range(200)]  # one header and footer; 30 pairs of copies
    labels = spark.createDataFrame([(k, int(k % 2 if k < 20 else k % 4 == 0)) for k in range(200)], "doc_id long, toxic int")
    kept = {r.doc_id for r in toxicity.training_rows(spark, frame(spark, rows), labels, 1000).collect()}
    known = {r.doc_id: r.toxic for r in labels.where(~toxicity.held_out()).collect()}
    first = {}
    for k in sorted(known):
        first.setdefault((dict(rows)[k], known[k]), k)
    assert len(kept) == len(first) < len(known)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op3_toxicity"](spark, sf).collect()
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    mine = [(r.predicted, labels[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in labels]
    hits = sum(p and t for p, t, _ in mine)
    assert hits >= 0.95 * sum(p for p, _, _ in mine) and hits >= 0.8 * sum(t for _, t, _ in mine)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    got = toxicity.op3_toxicity(spark, frame(spark, EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    assert toxicity.op3_toxicity(spark, frame(spark, []), labels).collect() == []


# -- pipeline ----------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs if not k else kept, SF_SMALL)
        assert out.columns == docs.columns
        path = f"{spark.sparkContext.getCheckpointDir() or spark.conf.get('spark.checkpoint.dir')}/stage-test-{k}-{id(out)}"
        out.write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
        texts[k] = sorted((r.doc_id, r.text) for r in kept.collect())
    everything = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    scores = QUERIES["op3_toxicity"](spark, SF_SMALL).collect()
    clean = {r.doc_id for r in scores if not r.predicted}
    assert texts[0] == sorted((i, t) for i, t in zip(everything["doc_id"], everything["text"]) if i in clean)
    best = {}
    for i, t in texts[0]:
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0, "")), (-len(t), i, t))
    assert texts[1] == sorted((i, t) for _, i, t in best.values())
    names = slow_components(texts[1], [slow_fingerprint(t) for _, t in texts[1]])
    assert texts[2] == [(i, t) for (i, t), c in zip(texts[1], names) if c == i]
    assert {i for i, _ in texts[3]} <= {i for i, _ in texts[2]}
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    want = defaultdict(int)
    for i, _ in texts[3]:
        want[i] += 1
    got = defaultdict(int)
    for r in packed:
        got[r.doc_id] += r.piece == 0
    assert got == want


def test_stages_take_extra_columns_and_nulls(spark):
    from pyspark.sql import functions as F
    extra = ("row", "name", "copies", "score", "label", "fp", "digest", "rank", "target", "n", "kept", "size", "of",
             "text_hash", "n_points", "source_size", "_part")
    odd = frame(spark, [*EDGE, (None, "no id either"), (None, "no id")]).withColumns(
        {c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in extra})
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(spark, df, SF_SMALL)
            rows = out.collect()
            if stage is not corpus_pipeline.packed:
                assert out.columns == odd.columns
                assert all(r[c] == f"{c}{'-' if r.doc_id is None else r.doc_id}" for r in rows for c in extra)
    bare = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in EDGE} | {"noideither"}
    kept = corpus_pipeline.without_copies(spark, odd, SF_SMALL).collect()
    assert len(kept) == len(bare)
    near = corpus_pipeline.without_near_copies(spark, odd, SF_SMALL).collect()
    rows = [*EDGE, (None, "no id either"), (None, "no id")]
    fps = [slow_fingerprint(t) for _, t in rows]
    # one row per component, also where no row of it has an id
    roots = {min(j for j in range(len(rows)) if bin(fps[j] ^ f).count("1") <= 2) for f in fps}
    assert len(near) == len(roots)
