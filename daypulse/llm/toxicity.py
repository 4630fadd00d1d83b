"""Toxicity behind obfuscation: a noisy-channel decoder restores disguised words
under a character language model, then the restored text is scored."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import hashed_sample, saved, text_or_empty, whole_row

#: Bound on the labelled rows the classifier is fitted on (smallest hashes first).
TRAIN_ROWS = 20_000
#: A feature needs this many toxic documents.
MIN_SUPPORT = 4
MIN_PRECISION = 0.3
THRESHOLD = 0.7
#: One word rejects a text only at this precision; weaker words must add up to it.
SURE = 0.9
PREFIXES = range(3, 8)
#: Longer tokens are parted at their marks, and what is still longer is read in
#: overlapping windows.
MAX_TOKEN = 64
#: Tokens whose looks a worker remembers.
CACHED = 1 << 17

# -- channel (fixed values: what a writer may put for a letter) ----------------
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
    "*": "aeiou", "#": "aeiou", "%": "aeiou"}
SEPARATORS = " .-_*~'`^/,"
#: Costs in nats: a look-alike, a dropped separator, a dropped mark, a dropped
#: look-alike, a dropped repeat (in a run of two, in a longer run), a separator
#: that parts words.
C_ALIKE, C_JOIN, C_MARK, C_LOST, C_TWICE, C_RUN, C_PART = 0.7, 0.5, 3.0, 12.0, 4.0, 0.3, 9.0
#: A gap inside a word, between neighbouring chunks of a text.
C_INSIDE = 2.0
#: Signs of the channel and letters as the letter of their class (look-alikes of
#: several letters put those in one class); all other bytes are gaps.
_CLASSES = {"o": "0o", "i": "1!|il", "z": "2z", "e": "3e", "a": "4@a", "s": "5$s", "g": "689bg", "t": "7+t", "c": "(c"}
_CLASSES |= {c: c for c in "dfhjkmnpqruvwxy"}
CLASS = bytes.maketrans("".join(_CLASSES.values()).encode(), "".join(c * len(x) for c, x in _CLASSES.items()).encode())
GAPS = bytes(set(range(256)) - set("".join(_CLASSES.values()).encode()))
#: Letters of other alphabets that look like Latin ones (what NFKD leaves apart).
FOREIGN = str.maketrans("авекмнорстухіјѕԁһԛԝɡɩαβεικνορτυχꜱıøłđ€£", "abekmhopctyxijsdhqwgiabeiknoptuxsioldel")

WORDS = re.compile(r"[^\W\d_]+")
EDGES = ".,;:?\"'()[]{}<>&%*#!|-_~/\\`^="
_SPACED = re.compile(r"(?<![^\W_])[a-z0-9@$!|+](?:[ .\-_*~/]{1,2}[a-z0-9@$!|+](?![^\W_])){3,}")
_FOREIGN = re.compile("[" + "".join(map(chr, FOREIGN)) + "]")
_CHUNK = re.compile(r"[a-z0-9]+|[@$!|+(]").findall
_RUN = re.compile(r"([^\W\d_])\1\1")
_TWICE = re.compile(r"([^\W\d_])\1+")

# -- character language model --------------------------------------------------
# Symbols: 0 word boundary, 1..26 a to z, 27 any other letter.
N_SYMBOLS = 28
_SYMBOL_OF_BYTE = np.zeros(256, np.int32)
_SYMBOL_OF_BYTE[97:123] = _SYMBOL_OF_BYTE[65:91] = np.arange(1, 27)
_SYMBOL_OF_BYTE[192:256] = 27
_KEEP_BYTE = np.ones(256, bool)
_KEEP_BYTE[128:192] = False  # continuation bytes


def fold(text: str) -> str:
    """The text in lower case as ASCII: accents taken off, full-width and foreign
    look-alike letters as Latin ones, other scripts left out. Edges of the channel
    without a choice."""
    low = text.lower()
    if low.isascii():
        return low
    low = unicodedata.normalize("NFKD", low)
    if _FOREIGN.search(low):
        low = low.translate(FOREIGN)
    return low.encode("ascii", "ignore").decode().lower()


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams; after a boundary only one symbol of context."""
    raw = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-8", "replace"), np.uint8)
    s = _SYMBOL_OF_BYTE[raw[_KEEP_BYTE[raw]]]
    s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]
    a, b, c = s[:-2], s[1:-1], s[2:]
    return np.bincount((np.where(b > 0, a, 0) * N_SYMBOLS + b) * N_SYMBOLS + c,
                       minlength=N_SYMBOLS ** 3)


def character_counts(docs: DataFrame) -> DataFrame:
    """``gram, n`` over the whole text of every row, combined per task first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_SYMBOLS ** 3, np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                total += trigram_counts(batch.column("text")[k:k + 256].to_pylist())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    return (docs.select(text_or_empty().alias("text")).mapInArrow(scan, "gram int, n bigint")
                .groupBy("gram").agg(F.sum("n").alias("n")))


def language_model(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated with bigrams and a uniform floor."""
    tri = counts.reshape(N_SYMBOLS, N_SYMBOLS, N_SYMBOLS).astype(float)
    bi = tri.sum(axis=0)
    p2 = (bi + 0.1) / (bi.sum(axis=1, keepdims=True) + 0.1 * N_SYMBOLS)
    p3 = (tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


class Decoder:
    """Viterbi decoding of one token's character lattice under the model."""

    def __init__(self, model: np.ndarray):
        self.cost = model.tolist()
        self.known: dict[str, str] = {}

    @staticmethod
    def repeat(token: str, k: int) -> float:
        """Cost of dropping character k, which equals the one before it."""
        c = token[k]
        run = k > 1 and token[k - 2] == c or k + 1 < len(token) and token[k + 1] == c
        return C_RUN if run else C_TWICE

    def options(self, token: str, k: int) -> list[tuple[str, float]]:
        """What the writer may have meant by character k: (text, cost)."""
        c, out = token[k], []
        if c.isalpha():
            out.append((c, 0.0))
            if k and token[k - 1] == c:
                out.append(("", self.repeat(token, k)))
            return out
        out += [(x, C_ALIKE) for x in LOOKALIKES.get(c, "")]
        if c in SEPARATORS:
            out += [("", C_JOIN), (" ", C_PART)]
        else:
            lost = C_LOST if c in LOOKALIKES and c not in "*#%" else C_MARK
            out.append(("", self.repeat(token, k) if k and token[k - 1] == c else lost))
        return out

    def decode(self, token: str) -> str:
        """Cheapest reading of ``token`` (lower case); spaces part its words."""
        found = self.known.get(token)
        if found is not None:
            return found
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for k in range(len(token)):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            choices = self.options(token, k)
            for (a, b), (cost, text) in paths.items():
                row = self.cost[a][b]
                for out, extra in choices:
                    if not out:
                        state, total = (a, b), cost + extra
                    elif out == " ":
                        if not b:
                            continue
                        state, total = (0, 0), cost + extra + row[0]
                    else:
                        s = symbol(out)
                        state, total = (b, s), cost + extra + row[s]
                    if state not in after or total < after[state][0]:
                        after[state] = (total, text + out)
            paths = after       # every state is kept: at most one per pair of symbols
        ends = [(cost + (self.cost[a][b][0] if b else 0.0), text) for (a, b), (cost, text) in paths.items()]
        found = min(ends)[1].strip() if ends else ""
        if len(token) <= MAX_TOKEN:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[token] = found
        return found


    def read(self, chunks: list[str], joined: bool) -> tuple[float, str]:
        """Cost and text of the cheapest reading of neighbouring chunks (letters
        and signs) as one word, or as the words they are written as. Every sign
        may be any of its letters."""
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for n, chunk in enumerate(chunks):
            if n and joined:
                paths = {state: (cost + C_INSIDE, text) for state, (cost, text) in paths.items()}
            elif n:
                paths = {(0, 0): min((cost + (self.cost[a][b][0] if b else 0.0), text + " ")
                                     for (a, b), (cost, text) in paths.items())}
            for k, c in enumerate(chunk):
                after: dict[tuple[int, int], tuple[float, str]] = {}
                choices = [(c, 0.0)] if c.isalpha() else [(x, C_ALIKE) for x in LOOKALIKES.get(c, "")] or [("", C_MARK)]
                if k and chunk[k - 1] == c:
                    choices.append(("", self.repeat(chunk, k)))
                for (a, b), (cost, text) in paths.items():
                    for out, extra in choices:
                        s = symbol(out) if out else -1
                        state, total = ((b, s), cost + extra + self.cost[a][b][s]) if out else ((a, b), cost + extra)
                        if state not in after or total < after[state][0]:
                            after[state] = (total, text + out)
                paths = after
        return min((cost + (self.cost[a][b][0] if b else 0.0), text) for (a, b), (cost, text) in paths.items())


def classed(text: str) -> str:
    """The letters and signs of an ASCII text without its gaps, by their classes."""
    return text.encode().translate(CLASS, GAPS).decode()


class Scattered:
    """Finds words whose letters a text holds in order with gaps between them, or
    under accents and foreign letters.

    Only a reading that restores a scored word can change a score, so the chunks
    of the folded text, written together by class of letter, are searched for the
    words (Aho-Corasick, whatever the gaps are made of). Where one spans whole
    chunks, both readings of them are decoded, signs open: the word counts if it
    is cheaper than the chunks as they are written."""

    def __init__(self, words: Iterable[str], decoder: Decoder):
        import ahocorasick

        self.decoder, self.words = decoder, frozenset(w for w in words if len(w) > 3 and w.isascii())
        self.search = ahocorasick.Automaton()
        for w in self.words:
            self.search.add_word(classed(w), len(w))
        if self.words:
            self.search.make_automaton()

    def find(self, text: str) -> list[str]:
        if not self.words:
            return []
        low = fold(text)
        hits = list(self.search.iter(classed(low)))
        if not hits:
            return []
        chunks, plain = _CHUNK(low), low == text.lower()
        starts = np.cumsum([0, *map(len, chunks)])
        found = []
        for end, size in hits:
            first, last = end + 1 - size, end + 1
            a, b = np.searchsorted(starts, (first, last))
            if starts[a] != first or starts[b] != last or (plain and b - a == 1):
                continue    # part of a chunk, or a word that is read as it stands
            cost, word = self.decoder.read(chunks[a:b], True)
            if word in self.words and (b - a == 1 or cost < self.decoder.read(chunks[a:b], False)[0]):
                found.append(word)
        return found

    def __reduce__(self):
        return Scattered, (self.words, self.decoder)


@lru_cache(CACHED)
def hidden(w: str) -> tuple[str, ...]:
    """What of a token without white space may hide a word: letters mixed with
    look-alikes or marks, and runs of a letter."""
    if w.isalpha():
        return (w,) if len(w) > 3 and _RUN.search(w) else ()
    bare = w.strip(EDGES)
    if bare.endswith("'s"):
        bare = bare[:-2]
    out = []
    if bare.isalpha():
        if _RUN.search(bare):
            out.append(bare)
        # runs of marks at an edge are punctuation here; the search for scattered
        # letters reads them as letters
        if (w[0] in "$@!|(" or w.rstrip(".,;:?\"'")[-1:] in ("$", "@", "!", "|")) and "!!" not in w:
            out.append(w.strip(".,;:?\"'"))
    elif len(bare) > MAX_TOKEN:
        # a chain such as a.b.c or a path: its parts stand for themselves
        out += [p for p in re.split(r"[^\w@$!|+€£]+", bare) if len(p) >= 3 and not p.isalpha()]
    elif len(bare) >= 3 and any(map(str.isalpha, bare)):
        out.append(bare)
        if w[0] in "$@!|(" or w[-1] in "$@|":
            out.append(w.strip(".,;:?\"'"))
    return tuple(out)


def disguised(low: str) -> list[str]:
    """Tokens of a lower-case text that may hide a word, and letters spaced apart."""
    out = [p for w in set(low.split()) for p in hidden(w)]
    out += [m.group() for m in _SPACED.finditer(low)]
    return out


def pieces(token: str) -> Iterator[str]:
    """Long spaced runs in overlapping windows, so that no word is cut."""
    if len(token) <= 4 * MAX_TOKEN:
        yield token
        return
    step = 2 * MAX_TOKEN
    for k in range(0, len(token) - step, step):
        yield token[k:k + 2 * step]


def restore(text: str | None, decoder: Decoder) -> str:
    """The text in lower case with its disguised tokens decoded in place."""
    low = (text or "").lower()
    for token in sorted(set(disguised(low)), key=lambda t: (-len(t), t)):
        low = low.replace(token, " ".join(decoder.decode(p) for p in pieces(token)))
    return low


@lru_cache(CACHED)
def squeeze(word: str) -> str:
    return _TWICE.sub(r"\1", word)


def readings(low: str, decoder: Decoder, squeezed: dict[str, str] | None = None) -> tuple[set[str], list[str]]:
    """Words of the restored text: the plain ones with those its disguised
    tokens decode to; apart, what spaced letters spell without their gaps.
    ``squeezed`` names known words by their form without doubled letters. These
    are common, so a plain word that has some is decoded only if it is known
    without them; a disguised token stands for a known word of its form."""
    words, spelled = set(WORDS.findall(low)), []
    if squeezed:
        for w in [w for w in words if squeeze(w) in squeezed and squeeze(w) != w]:
            words.add(decoder.decode(w))
    for token in disguised(low):
        for p in pieces(token):
            found = WORDS.findall(decoder.decode(p))
            words.update(found)
            if squeezed:
                words.update(squeezed[squeeze(w)] for w in found if squeeze(w) in squeezed)
            if len(p) >= 7 and p[1] in SEPARATORS and p[3] in SEPARATORS:
                spelled.append("".join(found))
    return words, spelled


def features(text: str | None, decoder: Decoder) -> set[str]:
    """Words of the restored text and their beginnings (``=word``, ``begin``)."""
    words, _ = readings((text or "").lower(), decoder)
    out = {"=" + w for w in words}
    for n in PREFIXES:
        out.update({w[:n] for w in words if len(w) > n})
    return out


# -- classifier ------------------------------------------------------------------

def held_out() -> Column:
    """Labels of these rows are never learned."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: Rows are copies from this similarity of their 5-word shingles on. Sketches find
#: them by equal bands, and the shingles themselves decide.
COPY, SKETCH, BAND = 0.8, 128, 8
_SLOTS = np.random.default_rng(11).integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str) -> np.ndarray:
    words = text.split()
    return np.unique(np.array([hash_words(words[k:k + 5]) for k in range(max(1, len(words) - 4))], np.uint64))


def sketch(text: str) -> bytes:
    """Low bits of SKETCH min-hashes: as many agree as the texts are similar."""
    held = shingles(text)
    return np.array([(held * x).min() & np.uint64(0xFFFF) for x in _SLOTS], np.uint16).tobytes()


def similarity(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def likely_copies(held: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """(key, key of the row it seems to copy) over rows (key, label, sketch). A
    row that others copy copies none itself."""
    slots = np.frombuffer(b"".join(h[2] for h in held), np.uint16).reshape(-1, SKETCH)
    seen: dict[tuple, list[int]] = {}
    out = []
    for n, (key, label, raw) in enumerate(held):
        bands = [(label, k, raw[2 * k:2 * (k + BAND)]) for k in range(0, SKETCH, BAND)]
        near = sorted({m for x in bands for m in seen.get(x, ())})
        alike = (slots[near] == slots[n]).mean(axis=1) if near else np.zeros(0)
        if len(alike) and alike.max() >= COPY - 0.1:
            out.append((key, held[near[int(alike.argmax())]][0]))
        else:
            for x in bands:
                seen.setdefault(x, []).append(n)
    return out


def hash_words(words: list[str]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(" ".join(words)) >> 1


def training_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows that are not held out, without those that
    copy another one with their label, so that a text copied a thousand times
    counts once. Each is held against the row that stays for it."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    # the bound holds for rows, not ids; they are chosen before any text moves
    chosen = texts.select("doc_id", "key").join(known.where(~held_out()), "doc_id").distinct()
    chosen = saved(spark, chosen, "toxic-known")
    chosen = hashed_sample(chosen, ["doc_id", "key"], bound, chosen.count())
    rows = texts.join(F.broadcast(chosen.drop("doc_id")), "key").dropDuplicates(["key"])
    rows = saved(spark, rows, "toxic-train")

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "key", "toxic")), pa.array(found, pa.binary())],
                names=["doc_id", "key", "toxic", "sketch"])

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")

    held = rows.select("doc_id", "key", F.col("toxic").cast("int"), "text").mapInArrow(
        sketches, "doc_id bigint, key bigint, toxic int, sketch binary").orderBy("doc_id", "key").collect()
    pairs = likely_copies([(r["key"], r["toxic"], bytes(r["sketch"])) for r in held])
    if not pairs:
        return rows.drop("key")
    pairs = F.broadcast(spark.createDataFrame(pairs, "key bigint, stays bigint"))
    both = rows.select("key", "text").join(pairs, "key").join(
        rows.select(F.col("key").alias("stays"), F.col("text").alias("other")), "stays")
    copies = both.where(alike("text", "other") >= COPY).select("key")
    return saved(spark, rows.join(copies, "key", "left_anti").drop("key"), "toxic-distinct")


def feature_counts(rows: DataFrame, decoder: Decoder) -> DataFrame:
    """``feature, hits, n``: toxic rows and all rows that hold a feature."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, total = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                held = features(text, decoder)
                total.update(held)
                if toxic == 1:
                    hits.update(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([hits[f] for f in total], pa.int64()),
             pa.array(list(total.values()), pa.int64())], names=["feature", "hits", "n"])

    return (rows.select("text", F.col("toxic").cast("int")).mapInArrow(scan, "feature string, hits bigint, n bigint")
            .groupBy("feature").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")))


def precise(counts: DataFrame, support: int, precision: float, z: float = 1.0) -> DataFrame:
    """Features with that many toxic rows whose Wilson lower bound of hits / n
    reaches the precision, with the bound as ``score``."""
    n, p = F.col("n"), F.col("hits") / F.col("n")
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    score = (p + z * z / (2 * n) - spread) / (1 + z * z / n)
    return counts.where(F.col("hits") >= support).withColumn("score", score).where(F.col("score") >= precision)


class Model:
    """Decoder, feature scores and prior; small, and sent to tasks as it is."""

    def __init__(self, decoder: Decoder, scores: dict[str, float], prior: float):
        self.decoder, self.scores, self.prior = decoder, scores, prior
        self.words = frozenset(f[1:] for f in scores if f[0] == "=")
        self.squeezed = {squeeze(f[1:]): f[1:] for f, s in scores.items() if f[0] == "=" and s >= THRESHOLD}
        self.scattered = Scattered((f[1:] for f, s in scores.items() if f[0] == "=" and s >= THRESHOLD), decoder)
        self.begins = {n: frozenset(f for f in scores if f[0] != "=" and len(f) == n) for n in PREFIXES}

    def score(self, text: str | None) -> float:
        """Chance that the restored text is toxic: each of its words counts with
        its strongest feature, and independent words add up. Below SURE the
        score stays under the threshold. Without such words: the prior; empty
        texts: half the prior."""
        words, spelled = readings((text or "").lower(), self.decoder, self.squeezed)
        words.update(self.scattered.find(text or ""))
        if not words:
            return self.prior / 2
        found = [self.scores["=" + w] for w in words & self.words]
        for run in spelled:
            found += [self.scores["=" + w] for w in self.words if len(w) > 3 and w in run]
        for n, begins in self.begins.items():
            for start in {w[:n] for w in words if len(w) > n} & begins:
                held = sum(w.startswith(start) and w not in self.words for w in words)
                found += [self.scores[start]] * held
        if not found:
            return self.prior
        best = max(found)
        toxic = 1 - math.prod(1 - p for p in found if p >= THRESHOLD) if best >= THRESHOLD else best
        return toxic if toxic >= SURE else 0.75 * toxic


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Language model over all texts; classifier over the bounded training rows.
    What reaches the driver is bounded by the alphabet and by ``train_rows``."""
    counts = np.zeros(N_SYMBOLS ** 3, np.int64)
    for r in character_counts(docs).collect():
        counts[r["gram"]] = r["n"]
    decoder = Decoder(language_model(counts))
    rows = training_rows(spark, docs, labels, train_rows)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_all = size.get(1, 0), sum(size.values())
    prior = min(0.3, (n_toxic + 1) / (n_all + 10))
    kept = precise(feature_counts(rows, decoder), MIN_SUPPORT, MIN_PRECISION).collect()
    toxic = {r["feature"]: r["hits"] for r in kept}
    # a beginning says more than its longest words or beginnings only if several
    # share it: "mor" adds nothing to "moron", "lost" nothing to "lostra"
    longer: dict[str, float] = {}
    for f, n in toxic.items():
        for k in PREFIXES:
            begin, weight = (f[1:k + 1], 1.3 * n) if f[0] == "=" else (f[:k], 1.1 * n)
            if f[0] == "=" or k < len(f):
                longer[begin] = max(weight, longer.get(begin, 0))
    toxic = {f: n for f, n in toxic.items() if f[0] == "=" or n > longer.get(f, 0)}
    return Model(decoder, {r["feature"]: r["score"] for r in kept if r["feature"] in toxic}, prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` for the whole text of every row."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([model.score(t) for t in part], dtype="float64")

    return docs.withColumn("score", score(text_or_empty()))


def restored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``restored``: the whole text in lower case, its disguised
    tokens decoded in place (null: empty)."""

    @F.pandas_udf("string")
    def decode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([restore(t, model.decoder) for t in part], dtype="object")

    return docs.withColumn("restored", decode(text_or_empty()))


def reject(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    model = fit(spark, docs, labels)
    rows = docs.select(whole_row(docs), "text")
    return scored(rows, model).where(F.col("score") < THRESHOLD).select("row.*")


def op3_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every row. Null texts count as empty; repeated rows stay; without
    labels every score is the prior."""
    judged = scored(docs.select(F.col("doc_id").cast("long"), "text"), fit(spark, docs, labels))
    return judged.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
