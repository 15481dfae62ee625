"""Chat formatting with offset-aligned loss masks.

A conversation's turns, in order, are rendered as ``<|turn|>role<|says|>text<|done|>``.  Inside roles
and texts every ``<``, backslashes, ``|`` gets one more backslash, so none holds a control string and
reading back removes exactly that backslash.  The rendered text is encoded once with offsets; the
control strings are added tokens, so no token crosses the border of a turn.  The loss mask marks the
tokens that overlap a turn span of the assistant: spans and tokens are both sorted, and a binary
search finds each token's span.

Conversations are rendered in segments of whole turns, each of at most ``SEGMENT_CHARS`` unless one
turn is longer; segment borders are turn borders, so tokens are those of the whole conversation.
Rows are range-partitioned by conversation and turn: a conversation with a third of all rows is
rendered and encoded by many tasks.  Reading back streams a conversation's segments in order, with
memory bounded by one segment.

Defined results: a null text or role counts as empty; a null turn comes first; equal turns are
ordered by role and text, and repeated rows are turns of their own; null ids form one conversation;
an empty table gives an empty table; only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, pre_tokenizers, processors

from .common import bound_batches

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
LOSS_ROLE = "assistant"
SEGMENT_CHARS = 1 << 20

_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(DONE), re.S)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    # Offsets keep the space that belongs to a token.
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    tok.encode_special_tokens = False
    tok.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (TURN, SAYS, DONE)])
    return tok


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The rendered text and the sorted spans (start, end) of the texts that carry loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + SAYS, escape(text)
        if role == LOSS_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, DONE]
        at += len(head) + len(body) + len(DONE)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span.  Both are sorted; spans do not overlap."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")     # the first span that ends behind the token's start
    inside = at < len(spans)
    return inside & (spans[np.minimum(at, len(spans) - 1), 0] < offsets[:, 1])


FORMATTED = "conv_id {kind}, segment bigint, formatted string, ids array<int>, loss array<boolean>, loss_spans array<int>"


def format_conversations(df: DataFrame, path: str) -> DataFrame:
    """Segments ``(conv_id, segment, formatted, ids, loss, loss_spans)`` of every conversation:
    ``loss`` marks tokens, ``loss_spans`` has the character ranges they cover (start, end, ...).
    Segments of a conversation rise by ``segment``, the place of their first turn."""
    bound_batches(df.sparkSession)
    kind = df.schema["conv_id"].dataType.simpleString()
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Texts of one conversation and turn stay together; turns of one conversation may part.
    rows = rows.repartitionByRange(n, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = rows.withColumn("at", F.monotonically_increasing_id())     # rises with the range partitions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        turns, size, conv, start = [], 0, None, None

        def segment() -> pa.RecordBatch:
            text, spans = render(turns)
            enc = tok.encode(text, add_special_tokens=False)
            offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
            loss = mask(offsets, spans)
            # What the marked tokens cover, tokens that share a character merged.
            cover = offsets[loss]
            if len(cover):
                new = np.r_[True, cover[1:, 0] > np.maximum.accumulate(cover[:, 1])[:-1]]
                ends = np.maximum.reduceat(cover[:, 1], np.flatnonzero(new))
                cover = np.stack([cover[new, 0], ends], 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], key_type), pa.array([start], pa.int64()), pa.array([text]), pa.array([enc.ids], pa.list_(pa.int32())),
                 pa.array([loss.tolist()], pa.list_(pa.bool_())), pa.array([cover.ravel().tolist()], pa.list_(pa.int32()))],
                ["conv_id", "segment", "formatted", "ids", "loss", "loss_spans"])

        for batch in batches:
            key_type = batch.column(0).type
            for c, role, text, at in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if turns and (c != conv or size + len(text) > SEGMENT_CHARS):
                    yield segment()
                    turns, size = [], 0
                if not turns:
                    conv, start = c, at
                turns.append((role, text))
                size += len(text) + len(role) + 32
        if turns:
            yield segment()

    return rows.mapInArrow(run, FORMATTED.format(kind=kind))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted text and loss spans alone: turns and their
    digest, the unescaped text under the loss mask, and the length of the formatted text."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (formatted.select("conv_id", "segment", "formatted", "loss_spans").repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", "segment"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state = None
        for batch in batches:
            out = []
            for conv, text, spans in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if state is None or state[0] != conv:
                    if state:
                        out.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in _TURNS.findall(text):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(said)}\n".encode())
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    said = unescape(text[a:b])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            yield _digests(out, names, batch.column(0).type)
            key_type = batch.column(0).type
        if state:
            yield _digests([state], names, key_type)

    return rows.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _digests(rows: list, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2].hexdigest() for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.int64()),
         pa.array([r[4].hexdigest() for r in rows], pa.string()), pa.array([r[5] for r in rows], pa.int64())], names)
