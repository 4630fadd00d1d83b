"""Chat formatting at token level, with loss masks and escaped control strings."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import shuffle_tasks
from daypulse.llm.tokens import ByteEncoder, tokenizer_path

#: Lossless (byte-level) vocabulary; the reserved ids follow its last id.
TOKENIZER_FILE = "byte_bpe_50k.json"
#: Template of a turn: <s> role [INST] text [/INST] </s>. Fixed values.
BEGIN, TEXT, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
RESERVED = (BEGIN, TEXT, CLOSE, END)
TRAINED_ROLE = "assistant"

# A control string inside a text gets one backslash after its first character;
# one that already has n of them gets another, so unescaping is exact.
_TAIL = r"(/?s>|/?INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _TAIL)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _TAIL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


class Turn(NamedTuple):
    """A turn read from its ids: role, text, the text under the loss mask, and the
    length of the turn as formatted (control strings of the content escaped)."""
    role: str
    text: str
    trained: str
    shown: int


class Template:
    """Encodes and reads turns; ids from ``first`` on are the reserved ones."""

    def __init__(self, path: str):
        self.encoder = ByteEncoder(path)
        self.first = self.encoder.vocab_size
        self.id = {name: self.first + k for k, name in enumerate(RESERVED)}

    def turn(self, role: str, text: str) -> tuple[np.ndarray, int, int]:
        """Ids of a turn, spliced from segments that are encoded apart, and the
        span of its text among them."""
        head, body = self.encoder.encode(escape(role)), self.encoder.encode(escape(text))
        ids = [self.id[BEGIN], *head, self.id[TEXT], *body, self.id[CLOSE], self.id[END]]
        return np.array(ids, np.int32), len(head) + 2, len(head) + 2 + len(body)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> Turn:
        """A turn from its ids and mask. Only reserved ids part them: no text can
        hold one. Each segment is decoded once; where the mask covers a whole
        one, its text is the trained one."""
        at = np.flatnonzero(ids >= self.first)
        if [int(x) - self.first for x in ids[at]] != [0, 1, 2, 3]:
            raise ValueError("not a formatted turn")
        head, body = (self.encoder.decode(ids[s:e].tolist()) for s, e in ((1, at[1]), (at[1] + 1, at[2])))
        text = unescape(body)
        under = np.flatnonzero(mask)
        if len(under) == at[2] - at[1] - 1 and (not len(under) or under[0] == at[1] + 1):
            trained = text
        else:
            trained = unescape(self.encoder.decode(ids[under].tolist()))
        return Turn(unescape(head), text, trained, sum(map(len, RESERVED)) + len(head) + len(body))

    def render(self, ids: np.ndarray) -> str:
        """The formatted text, control strings of the content still escaped."""
        out, at = [], [*np.flatnonzero(ids >= self.first).tolist(), len(ids)]
        for k, nxt in zip(at, at[1:]):
            out.append(RESERVED[int(ids[k]) - self.first])
            out.append(self.encoder.decode(ids[k + 1:nxt].tolist()))
        return "".join(out)


_templates: dict[str, Template] = {}


def template(path: str) -> Template:
    if path not in _templates:
        _templates[path] = Template(path)
    return _templates[path]


def loss_mask(n_ids: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """0/1 per id: prefix sum of +1 where a trained span opens, -1 where it ends."""
    change = np.zeros(n_ids + 1, np.int32)
    for a, b in spans:
        change[a] += 1
        change[b] -= 1
    return np.cumsum(change[:-1])


TURN_SCHEMA = ("conv_id bigint, nth bigint, first_id bigint, ids array<int>, "
               "loss_start bigint, loss_end bigint")


def format_turns(spark: SparkSession, turns: DataFrame, tokenizer: str,
                 trained: str = TRAINED_ROLE) -> DataFrame:
    """One row per turn, in order within each conversation: its ids, the place of
    its first id in the conversation (a prefix sum over turns) and the span of
    ids under the loss mask in the conversation's places (empty unless the role
    is ``trained``).

    Encoding, the heavy part, runs on evenly dealt rows before the shuffle. The
    order and the prefix sum of one conversation need it in one stream; it
    passes through in batches and is never held. Turns sort by turn (null
    first), then role and text, so ties and repeated rows have a place. Null
    role and text are empty; rows with a null conv_id are one conversation."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(tokenizer)
        for batch in batches:
            ids, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                found, a, b = form.turn(role, text)
                ids.append(found)
                starts.append(a)
                ends.append(b if role == trained else a)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "turn", "role", "text")),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "role", "text", "ids", "a", "b"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nth, place = object(), 0, 0
        for batch in batches:
            rows = ([], [], [], [])
            sizes = [len(x) for x in batch.column("ids")]
            for conv, size, a, b in zip(batch.column("conv_id").to_pylist(), sizes,
                                        batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                if conv != last:
                    last, nth, place = conv, 0, 0
                for column, v in zip(rows, (nth, place, place + a, place + b)):
                    column.append(v)
                nth, place = nth + 1, place + size
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                 batch.column("ids"), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())],
                names=["conv_id", "nth", "first_id", "ids", "loss_start", "loss_end"])

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    encoded = rows.mapInArrow(
        encode, "conv_id bigint, turn bigint, role string, text string, ids array<int>, a bigint, b bigint")
    ordered = (encoded.repartition(shuffle_tasks(spark), "conv_id")
                      .sortWithinPartitions("conv_id", "turn", "role", "text")
                      .select("conv_id", "ids", "a", "b"))
    return ordered.mapInArrow(assemble, TURN_SCHEMA)


DIGEST_SCHEMA = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                 "loss_sha256 string, formatted_chars bigint")


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Digests per conversation from the ids and spans of ``format_turns``, whose
    partitions and order it keeps: hashes are fed turn by turn."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(tokenizer)
        last, state, begun = None, None, False

        def row() -> tuple:
            n, turns, chars, loss, shown = state
            return last, n, turns.hexdigest(), chars, loss.hexdigest(), shown

        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "first_id", "loss_start", "loss_end")]
            for conv, first, start, end, ids in zip(*columns, batch.column("ids")):
                if not begun or conv != last:
                    if begun:
                        done.append(row())
                    begun, last, state = True, conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = ids.values.to_numpy(zero_copy_only=False)
                turn = form.read(ids, loss_mask(len(ids), [(start - first, end - first)]))
                state[0] += 1
                state[1].update(f"{turn.role}\n{turn.text}\n".encode())
                state[2] += len(turn.trained)
                state[3].update(turn.trained.encode())
                state[4] += turn.shown
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], schema=schema)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row()], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(digest, DIGEST_SCHEMA)


def op1_chat_formatting(spark: SparkSession, conversations: DataFrame,
                        tokenizer: str | None = None) -> DataFrame:
    """All conversations plus conversation -7, whose texts are control strings."""
    path = tokenizer or tokenizer_path(TOKENIZER_FILE)
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                 "conv_id bigint, turn bigint, role string, text string")
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(more)
    return read_back(format_turns(spark, turns, path), path)


OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                        (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (
  SELECT *, 20 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>)', '\1\\\2\3', 'g')) AS shown
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(shown)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
