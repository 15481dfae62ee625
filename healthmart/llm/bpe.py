"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split into pre-tokens by the vocabulary's pattern; each pre-token is merged on its own.
The queue has one bucket per merge rank, holding positions of the pre-token's linked list, and a
two-level bitmap over the ranks: find-first-set on both levels gives the lowest rank in use.
Entries are never removed when a merge changes a pair; they are skipped when popped, because the
pair at their position no longer has that rank.  The cost is O(n log n) for a pre-token of n bytes,
so very long pre-tokens are no special case.

A worker keeps bounded caches of encoded pre-tokens, and of chunks between single spaces, until it
works for another vocabulary or for the n-gram Jaccard join.

Defined results: a null text counts as empty (no tokens, digests of the empty string); rows are
independent, so repeated rows, ties and null ids give equal rows with their id as it is; an empty
table gives an empty table; only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, take_turn

#: Entries of a cache generation; a worker keeps two generations of pre-tokens and of chunks.
PIECES, CHUNKS = 400_000, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


class RankQueue:
    """Merges pre-tokens of one vocabulary; its buckets and bitmaps are empty between calls.

    A bucket is None, one position, or a heap of positions.
    """

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=0) + 1
        self.ranks = ranks
        self.buckets: list[int | list[int] | None] = [None] * size
        self.low = [0] * ((size >> 8) + 1)                      # bitmap of ranks, 256 to a word

    def encode(self, piece: bytes) -> list[int]:
        """Token ids: always the lowest rank merges, and among its pairs the leftmost."""
        get, n = self.ranks.get, len(piece)
        whole = get(piece)
        if whole is not None:
            return [whole]
        buckets, low, top = self.buckets, self.low, 0           # top: bitmap of the words in use
        nxt, prv = list(range(1, n + 2)), list(range(-1, n))    # linked list of part starts
        rank_at = [get(piece[i:i + 2]) for i in range(n)]       # rank of the pair that starts there
        rank_at[-1] = None
        rank_at.append(None)
        for at, r in enumerate(rank_at):
            if r is not None:
                held = buckets[r]
                if held is None:
                    buckets[r] = at
                    low[r >> 8] |= 1 << (r & 255)
                    top |= 1 << (r >> 8)
                elif type(held) is int:
                    buckets[r] = [held, at]
                else:
                    held.append(at)                             # rising positions are a heap
        while top:
            w = (top & -top).bit_length() - 1                   # find-first-set, level by level
            word = low[w]
            bit = word & -word
            r = w << 8 | bit.bit_length() - 1
            held = buckets[r]
            if type(held) is int:
                at, held = held, None
            else:
                at = heappop(held)
            if not held:
                buckets[r] = None
                low[w] = word ^ bit
                if word == bit:
                    top ^= 1 << w
            if rank_at[at] != r:
                continue                                        # stale
            gone = nxt[at]
            after = nxt[gone]
            nxt[at] = after
            prv[after] = at
            rank_at[gone] = None
            before = prv[at]
            rank_at[at] = r = get(piece[at:nxt[after]]) if after < n else None
            if before >= 0:
                rank_at[before] = left = get(piece[before:after])
                if left is not None:
                    held = buckets[left]
                    if held is None:
                        buckets[left] = before
                        low[left >> 8] |= 1 << (left & 255)
                        top |= 1 << (left >> 8)
                    elif type(held) is int:
                        buckets[left] = [held, before] if held < before else [before, held]
                    else:
                        heappush(held, before)
            if r is not None:
                held = buckets[r]
                if held is None:
                    buckets[r] = at
                    low[r >> 8] |= 1 << (r & 255)
                    top |= 1 << (r >> 8)
                elif type(held) is int:
                    buckets[r] = [held, at] if held < at else [at, held]
                else:
                    heappush(held, at)
        out, at, ranks = [], 0, self.ranks
        while at < n:
            out.append(ranks[piece[at:nxt[at]]])
            at = nxt[at]
        return out


class Codec:
    """Encoder and decoder of one vocabulary, with bounded caches; one for each worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for tok, r in ranks.items():
            self.bytes_of[r] = tok
        self.decimals = [str(i) for i in range(len(self.bytes_of))]
        queue = RankQueue(ranks)
        self.pieces = _Cache(lambda p: array("I", queue.encode(p.encode())).tobytes(), PIECES)
        self.chunks = _Cache(self._chunk, CHUNKS)

    def _chunk(self, chunk: str) -> bytes | None:
        # What follows a single space and holds no white space at its ends is split by the pattern
        # the same way in any text; anything else needs the whole text.
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return b"".join(map(self.pieces.__getitem__, self.split(" " + chunk)))

    def encode(self, text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        parts = list(map(self.chunks.__getitem__, rest))
        if None in parts or rest and first[-1:].isspace():
            parts = map(self.pieces.__getitem__, self.split(text))
        elif first:
            parts = [*map(self.pieces.__getitem__, self.split(first)), *parts]
        return np.frombuffer(b"".join(parts), np.uint32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def forget(self) -> None:
        self.pieces.forget()
        self.chunks.forget()


class _Cache(dict):
    """A bounded cache of two generations: entries that are not asked for again fall out."""

    def __init__(self, make, entries):
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.make(key)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self):
        self.clear()
        self.older = {}


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


#: Token ids gathered before a batch of results is handed on.
OUT_IDS = 4_000_000


def encode(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256[, ids])`` of each row of ``df``.

    ``decoded_sha256`` is the digest of the bytes that decoding the ids gives back.
    """
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        take_turn(c)
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
        for batch in batches:
            key, texts = batch.column(0), batch.column(1)
            start, out, kept = 0, [], 0
            for i in range(len(texts)):
                ids = c.encode(texts[i].as_py())
                plain = ids.tolist()
                out.append((len(plain), hashlib.sha256(" ".join(map(c.decimals.__getitem__, plain)).encode()).hexdigest(),
                            hashlib.sha256(c.decode(plain)).hexdigest(), ids))
                kept += len(plain) * with_ids
                if kept >= OUT_IDS or i == len(texts) - 1:
                    cols = [key.slice(start, i + 1 - start), pa.array([r[0] for r in out], pa.int64()),
                            pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string())]
                    if with_ids:
                        ends = np.cumsum([0] + [r[0] for r in out]).astype(np.int32)
                        flat = np.concatenate([r[3] for r in out]) if out else np.empty(0, np.uint32)
                        cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(cols, names)
                    start, out, kept = i + 1, [], 0

    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, decoded binary)`` of each row's token ids; null ids decode to no bytes."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            out = [c.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, decoded binary")
