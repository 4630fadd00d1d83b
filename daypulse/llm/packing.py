"""Best-fit packing of token documents after Martello-Toth dominance reduction."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import ranked, saved, shuffle_tasks
from daypulse.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """Every text (null: empty) as ids with ``end_id`` after them, cut into
    pieces of ``capacity``; only longer documents have more than one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows = [[], [], [], [], []]
            for name, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.append(enc.encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for column, v in zip(rows, (name.as_py(), k, start, len(part),
                                                zlib.crc32(part.tobytes()))):
                        column.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE_SCHEMA)


class Stock:
    """How many items of each length are left; lengths are 1 to capacity."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def lengths(self) -> np.ndarray:
        return np.flatnonzero(self.left)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n


def reduce_dominated(stock: Stock) -> list[tuple[tuple[int, ...], int]]:
    """Fixes sets that provably dominate every other set with their largest item.

    For the largest item j with free room r, and all items left:
    * an item of length r exists: {j, r} is full, and whatever else a solution
      puts beside j fits where that item was, so the pair can be fixed;
    * no two items fit into r: the largest single item that fits dominates (none
      fits: j stays alone);
    * two but not three fit: the largest single item k dominates if it is at
      least as long as the best pair, which then fits where k was.
    Works on counts per length, many equal sets at a time, and returns
    (lengths, how many sets). Items it cannot decide stay in the stock."""
    fixed = []
    for j in stock.lengths()[::-1]:
        j = int(j)
        room = stock.capacity - j
        while stock.left[j]:
            n = int(stock.left[j])
            if room == 0:
                stock.take(j, n)
                fixed.append(((j,), n))
                break
            stock.left[j] -= 1  # one j opens the set; the others are candidates
            here = np.flatnonzero(stock.left[:room + 1])
            smallest = [int(x) for x in here[:3]]
            three = [x for x in smallest for _ in range(min(3, int(stock.left[x])))][:3]
            stock.left[j] += 1
            if not len(here):
                stock.take(j, n)
                fixed.append(((j,), n))
                break
            k = int(here[-1])
            pairs_with_itself = k == j
            times = n // 2 if pairs_with_itself else min(n, int(stock.left[k]))
            alone = len(three) < 2 or three[0] + three[1] > room
            if not (k == room or alone):
                four = len(three) == 3 and sum(three) <= room
                if four or k < best_pair(stock, j, here, room):
                    break
            # fewer items left only strengthen each condition, so it holds for all
            stock.take(j, times)
            stock.take(k, times)
            fixed.append(((j, k), times))
    return fixed


def best_pair(stock: Stock, j: int, here: np.ndarray, room: int) -> int:
    """Largest sum of two items of lengths ``here`` (sorted, beside one j) that
    is at most ``room``: two pointers, and pairs of equal length apart."""
    twice = [int(x) for x in here if 2 * x <= room and stock.left[x] - (x == j) >= 2]
    best, low, high = 2 * max(twice, default=0), 0, len(here) - 1
    while low < high:
        total = int(here[low] + here[high])
        if total <= room:
            best, low = max(best, total), low + 1
        else:
            high -= 1
    return best


def best_fit(stock: Stock) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal bins move together. Items go, the
    longest first, into the fullest bins that hold them."""
    classes: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in classes:
            classes[room] = []
            heapq.heappush(rooms, room)
        classes[room].append((items, n))

    done = []
    for length in stock.lengths()[::-1]:
        length, n = int(length), int(stock.left[length])
        # rooms too small for this length may suit a shorter one: set aside
        aside = []
        while n and rooms:
            room = rooms[0]
            if room < length:
                aside.append(heapq.heappop(rooms))
                continue
            items, m = classes[room].pop()
            if not classes[room]:
                del classes[room]
                heapq.heappop(rooms)
            per = min(room // length, n)
            bins = min(m, n // per)
            if bins < m:
                put(room, items, m - bins)
            put_now = room - per * length
            n -= bins * per
            if put_now in classes:
                classes[put_now].append((items + (length,) * per, bins))
            else:
                classes[put_now] = [(items + (length,) * per, bins)]
                if put_now < length:
                    aside.append(put_now)
                else:
                    heapq.heappush(rooms, put_now)
        for room in aside:
            heapq.heappush(rooms, room)
        if n:
            per = stock.capacity // length
            if n // per:
                put(stock.capacity - per * length, (length,) * per, n // per)
            if n % per:
                put(stock.capacity - n % per * length, (length,) * (n % per), 1)
        stock.left[length] = 0
        if 0 in classes:
            done += classes.pop(0)
            rooms = [r for r in rooms if r]
            heapq.heapify(rooms)
    return done + [c for held in classes.values() for c in held]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of a sequence, how many sequences) that use up ``counts``."""
    stock = Stock(counts, capacity)
    return reduce_dominated(stock) + best_fit(stock)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, list[np.ndarray]]:
    """Per length: arrays (first rank, first sequence, items per sequence, first
    offset), one entry per pattern that holds the length. The items of a length
    with ranks from ``first rank`` on fill the pattern's sequences in turn."""
    used: Counter = Counter()
    out: dict[int, list[list[int]]] = {}
    sequence = 0
    for lengths, n in patterns:
        offset = 0
        for length, per in sorted(Counter(lengths).items(), reverse=True):
            out.setdefault(length, []).append([used[length], sequence, per, offset])
            used[length] += n * per
            offset += length * per
        sequence += n
    return {length: list(np.array(rows, np.int64).T) for length, rows in out.items()}


PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id bigint, `offset` bigint"


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None,
                   capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and place.

    Only the histogram of lengths, at most ``capacity`` rows, reaches the
    driver; there the reduction and best fit work on counts. Pieces get a
    gapless rank among those of their length on the cluster, and the rank picks
    the slot. Null and empty texts are one end id. Equal rows are packed as
    often as they come. An empty table packs nothing."""
    pieces = saved(spark, pieces_of(docs, tokenizer or tokenizer_path(), capacity), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(counts, capacity))  # at most a few entries per length and pattern
    order = ["doc_id", "piece", "start", "ids_crc32"]
    with_rank = ranked(pieces, ["length"], order, "rank", shuffle_tasks(spark))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                first, seq, per, off = table[int(one)]
                k = np.searchsorted(first, rank[mine], "right") - 1
                nth = rank[mine] - first[k]
                sequence[mine] = seq[k] + nth // per[k]
                offset[mine] = off[k] + nth % per[k] * one
            columns = [batch.column(c) for c in
                       ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return with_rank.mapInArrow(place, PACKED_SCHEMA)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None,
              end_id: int = END_ID) -> DataFrame:
    """The packed token sequences: ``sequence_id, ids``, at most a capacity each.

    Each document is encoded once more and cut at the places of its pieces in
    ``packed`` (the result of ``pack_documents`` on ``docs``); copies of a row
    share a doc_id and one encoding."""
    path = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            rows = []
            for text, places in zip(batch.column("text"), batch.column("places").to_pylist()):
                ids = np.append(enc.encode(text.as_py()), np.uint32(end_id)).astype(np.int64)
                rows += [{"sequence_id": p["sequence_id"], "offset": p["offset"],
                          "ids": ids[p["start"]:p["start"] + p["length"]].tolist()} for p in places]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("name")
    places = packed.groupBy(name).agg(F.collect_list(
        F.struct("sequence_id", "offset", "start", "length")).alias("places"))
    texts = docs.select(name, "text").dropDuplicates(["name"])
    parts = texts.join(places, "name").select("text", "places").mapInArrow(
        cut, "sequence_id bigint, `offset` bigint, ids array<int>")
    whole = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(whole, lambda x: x["ids"])).alias("ids"))


def op10_best_fit_packing(spark: SparkSession, docs: DataFrame,
                          tokenizer: str | None = None) -> DataFrame:
    return pack_documents(spark, docs, tokenizer)
