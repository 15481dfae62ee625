"""Training-order materialisation of token ids as binary shards.

Documents are tokenised, joined with an end token behind each, and cut into sequences of a fixed
length; only the last sequence of an input partition is padded.  The sequences are numbered
0 .. n - 1, and a keyed Feistel permutation of the smallest even number of bits that holds n gives
each its slot; values beyond n walk the cycle until they fall inside.  Ranges of slots make the
shards, ranges of shards the tasks, and each shard is one file of little-endian ids with a fixed stride, so the sequence in
slot s of a run stands at byte ``(s mod rows) * stride`` of file ``s div rows``: a reader goes on
from any slot without an index, and reads files front to back.

The tokenised sequences are a written table, so numbers never change when a task runs again; a shard
is written under a name of its own and moved into place whole, so repeated attempts agree.

Defined results: null and empty texts are only their end token; repeated rows, ties and null ids are
documents like any other; an empty table writes no file; only the id and text columns are read, so
others cannot clash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import bound_batches, scratch

ROUNDS = 4
#: Level of zstd for ids that wait to become shards, in the table of sequences and in the shuffle.  Higher levels take
#: half as much time again and save 1.5 per cent of the table, 0.1 of the shuffle.
LEVEL = 5
#: Ids of a task gathered before its whole sequences are handed on.
GATHER = 2_000_000


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of 0 .. n - 1 applied to ``x``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while todo.size:                                  # cycle-walking: again for those that fell outside
        v = out[todo]
        left, right = v >> np.uint64(half), v & low
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key, r) & low)
        v = left << np.uint64(half) | right
        out[todo] = v
        todo = todo[v >= n]
    return out.astype(np.int64)


def _mix(x: np.ndarray, key: int, r: int) -> np.ndarray:
    k = np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF)
    x = (x + k) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=LEVEL)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def token_ids(enc: tiktoken.Encoding, text: str, end_id: int) -> np.ndarray:
    """The 16-bit ids of a text and the end token.  There are no special tokens, so nothing is spent on looking for them."""
    ids = enc.encode_ordinary(text)
    ids.append(end_id)
    return np.array(ids, "<u2")


def sequences(df: DataFrame, path: str, pattern: str, end_id: int, length: int, *, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``(part, pos, n_tokens, doc_ids, ids)``: the sequences of each input partition in order; ``ids``
    holds 16-bit ids and ``doc_ids`` the documents with tokens in it."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        if enc.n_vocab > 1 << 16 or end_id >= 1 << 16:
            raise ValueError("ids are stored in 16 bits")
        held: list[tuple[int | None, np.ndarray]] = []
        size, pos, part = 0, 0, None

        def cut(last: bool) -> pa.RecordBatch:
            nonlocal held, size, pos
            ids = np.concatenate([a for _, a in held])
            ends = np.cumsum([len(a) for _, a in held])
            n = -(-len(ids) // length) if last else len(ids) // length
            out = []
            for k in range(n):
                a, b = k * length, min((k + 1) * length, len(ids))
                first, final = np.searchsorted(ends, a, "right"), np.searchsorted(ends, b - 1, "right")
                out.append((part, pos + k, b - a, [held[i][0] for i in range(first, final + 1)], ids[a:b].tobytes()))
            pos += n
            keep = int(np.searchsorted(ends, n * length, "right"))
            over = ends[keep] - n * length if keep < len(ends) else 0
            held = [(held[keep][0], held[keep][1][-over:]), *held[keep + 1:]] if over else held[keep + 1:]
            size = sum(len(a) for _, a in held)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int32()),
                 pa.array([r[3] for r in out], pa.list_(pa.int64())), pa.array([r[4] for r in out], pa.binary())], ["part", "pos", "n_tokens", "doc_ids", "ids"])

        for batch in batches:
            for i, t, p in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                part = p
                ids = token_ids(enc, t.as_py(), end_id)
                held.append((i, ids))
                size += len(ids)
                if size >= GATHER:
                    yield cut(False)
        if held:
            yield cut(True)

    return rows.mapInArrow(run, "part int, pos bigint, n_tokens int, doc_ids array<bigint>, ids binary")


def materialise(df: DataFrame, path: str, pattern: str, *, end_id: int, length: int, rows_per_shard: int, key: int,
                id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Write the shards and return, as read back from them, one row per sequence:
    ``(slot, shard, row, n_tokens, doc_ids, crc32)``.  ``folder`` is a URI that all executors reach
    (by default a new folder below the checkpoint folder)."""
    spark = df.sparkSession
    folder = (folder or scratch(spark, "token-shards")).rstrip("/")
    numbered = sequences(df, path, pattern, end_id, length, id_col=id_col, text_col=text_col)
    waiting = scratch(spark, "sequences")
    numbered.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(LEVEL)).parquet(waiting)
    table = spark.read.schema(numbered.schema).parquet(waiting)
    counts = sorted((r["part"], r["n"]) for r in table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())   # a row a task
    offsets, n = {}, 0
    for part, c in counts:
        offsets[part] = n
        n += c
    if not n:
        return spark.createDataFrame([], "slot bigint, shard bigint, row int, n_tokens int, doc_ids array<bigint>, crc32 bigint")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([offsets[p] for p in batch.column(0).to_pylist()], np.int64) + batch.column(1).to_numpy()
            packed = [codec().compress(x.as_buffer(), asbytes=True) for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays([pa.array(feistel(at, n, key)), *batch.columns[2:4], pa.array(packed, pa.binary())],
                                             ["slot", "n_tokens", "doc_ids", "ids"])

    placed = (table.mapInArrow(slots, "slot bigint, n_tokens int, doc_ids array<bigint>, ids binary")
              .withColumn("shard", F.floor(F.col("slot") / rows_per_shard).cast("bigint")))
    n_shards = -(-n // rows_per_shard)
    # A task owns whole shards and writes them front to back.  Its range follows from the number of shards:
    # range partitioning would place and pack all sequences once more, only to sample where ranges end.
    tasks = min(n_shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    owner = F.floor(F.col("shard") * tasks / n_shards).cast("int")
    ranged = placed.repartitionById(tasks, owner).sortWithinPartitions("slot")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        store.create_dir(base, recursive=True)
        stride = 2 * length
        shard, out, name, held = None, None, "", []

        def close() -> pa.RecordBatch:
            out.close()
            store.move(name, f"{base}/shard-{shard:08d}.bin")
            return read_shard(store, base, shard, held)

        for batch in batches:
            for slot, n_tokens, docs, ids, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    if out is not None:
                        yield close()
                    shard, held = s, []
                    name = f"{base}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                out.write(codec().decompress(ids, 2 * n_tokens, asbytes=True).ljust(stride, b"\0"))
                held.append((slot, n_tokens, docs))
        if out is not None:
            yield close()

    def read_shard(store, base, shard, held) -> pa.RecordBatch:
        stride, sums = 2 * length, []
        with store.open_input_stream(f"{base}/shard-{shard:08d}.bin") as f:
            for _, n_tokens, _ in held:
                sums.append(zlib.crc32(f.read(stride)[:2 * n_tokens]))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in held], pa.int64()), pa.array([shard] * len(held), pa.int64()), pa.array([r[0] % rows_per_shard for r in held], pa.int32()),
             pa.array([r[1] for r in held], pa.int32()), pa.array([r[2] for r in held], pa.list_(pa.int64())), pa.array(sums, pa.int64())],
            ["slot", "shard", "row", "n_tokens", "doc_ids", "crc32"])

    return ranged.mapInArrow(write, "slot bigint, shard bigint, row int, n_tokens int, doc_ids array<bigint>, crc32 bigint")


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder: a URI, also of the form ``file:/...``, or a plain path."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def resume(folder: str, slot: int, *, length: int, rows_per_shard: int) -> Iterator[np.ndarray]:
    """The sequences of a run from ``slot`` on, padded to ``length``, read front to back."""
    store, base = store_of(folder)
    shard, row = divmod(slot, rows_per_shard)
    while store.get_file_info(f"{base}/shard-{shard:08d}.bin").type == fs.FileType.File:
        with store.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
            f.seek(row * 2 * length)
            while chunk := f.read(2 * length):
                yield np.frombuffer(chunk, "<u2")
        shard, row = shard + 1, 0
