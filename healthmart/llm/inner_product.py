"""Exact top-k inner products, norm-sorted with SVD-rotated partial sums.

Vectors are integers, ``floor(64 x)``.  Candidates are sorted by falling length into blocks, queries
into blocks of their own, and every pair of blocks is one unit of work with bounded memory.  All
vectors are rotated by the right singular vectors of the whole table (from its Gram matrix), which
moves most of an inner product into the first coordinates.  The block of the longest candidates
goes first and gives each query a score that its result must reach.  In the other blocks a candidate
is dropped when even the greatest inner product it can have - at first by its length alone, then by
the partial sum of the first coordinates plus the Cauchy-Schwarz bound of the rest - falls short;
what is left is scored exactly, in integers.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
rows with a null id, nor vectors whose integer length reaches 2 ** 31.5 (their scores need not fit 64
bits); an empty vector and a shorter one count as padded with zeros; repeated rows count once; of several
vectors of one id the first by (dimensions, length, bytes) counts; rows with a query's own id are not its candidates; ties go to the smaller id; a query
with fewer candidates than k gets all of them; empty tables give empty tables; only the id and
vector columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, written
from .vectors import one_per_id

SCALE = 64
#: Longest integer vector: by Cauchy-Schwarz its scores fit 64 bits.
LONGEST = 2.0 ** 31.5
#: Vectors of a candidate block and of a query block; pairs tested at once.
CANDIDATES, QUERIES, QUERY_STEP = 4096, 1024, 128
#: Relative slack of bounds for rounding in the rotation.
SLACK = 1e-9


def _whole(v) -> np.ndarray | None:
    if v is None or any(x is None for x in v):
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        a = np.floor(SCALE * np.asarray(v, np.float64))
        return a.astype(np.int64) if float((a * a).sum()) < LONGEST ** 2 else None       # also not for nan


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, dims, norm, vec)``: integer vectors as bytes, with trailing zeros cut off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(i, np.trim_zeros(a, "b")) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    if i is not None and (a := _whole(v)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in kept], pa.int64()), pa.array([len(a) for _, a in kept], pa.int32()),
                 pa.array([float(np.sqrt((a.astype(np.float64) ** 2).sum())) for _, a in kept], pa.float64()),
                 pa.array([a.tobytes() for _, a in kept], pa.binary())], ["id", "dims", "norm", "vec"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    return one_per_id(rows.mapInArrow(run, "id bigint, dims int, norm double, vec binary"), "dims", "norm", "vec")


def _matrix(vecs: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(vecs), dims), np.int64)
    for i, v in enumerate(vecs):
        a = np.frombuffer(v, np.int64)
        out[i, :len(a)] = a
    return out


def _rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of the table of all vectors, the strongest first.  The driver gets one dims x dims
    Gram matrix, summed by its cells over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), dims).astype(np.float64)
            gram += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(gram.ravel())], ["cell", "value"])

    cells = vectors.select("vec").mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    gram = np.zeros(dims * dims)
    for r in cells.collect():
        gram[r["cell"]] = r["value"]
    _, v = np.linalg.eigh(gram.reshape(dims, dims))
    return np.ascontiguousarray(v[:, ::-1])


BLOCKS = "part int, nth bigint, n int, longest double, ids binary, vecs binary, floors binary"


def _blocks(rows: DataFrame, size: int, dims: int) -> DataFrame:
    """Rows ``(id, norm, vec, floor)`` in their order, ``size`` to a block; blocks are numbered inside
    their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nth = [], 0

        def block(rows, nth):
            x = _matrix([r[2] for r in rows], dims)
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0][4]], pa.int32()), pa.array([nth], pa.int64()), pa.array([len(rows)], pa.int32()),
                 pa.array([max(r[1] for r in rows)]), pa.array([np.array([r[0] for r in rows], np.int64).tobytes()], pa.binary()),
                 pa.array([x.tobytes()], pa.binary()), pa.array([np.array([r[3] for r in rows], np.float64).tobytes()], pa.binary())],
                ["part", "nth", "n", "longest", "ids", "vecs", "floors"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= size:
                yield block(held[:size], nth)
                held, nth = held[size:], nth + 1
        if held:
            yield block(held, nth)

    rows = rows.select("id", "norm", "vec", "floor", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, BLOCKS)


def _numbered(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Blocks numbered 0, 1, ... over all partitions; the driver sees one row a partition."""
    counts = sorted((r["part"], r["count"]) for r in blocks.groupBy("part").count().collect())
    offsets, at = [], 0
    for part, count in counts:
        offsets.append((part, at))
        at += count
    before = blocks.sparkSession.createDataFrame(offsets, "part int, before bigint")
    cols = ["n", "longest", "ids", "vecs", "floors"]
    return blocks.join(F.broadcast(before), "part").select((F.col("before") + F.col("nth")).alias(name), *cols), at


def _tile(q_ids, q, floors, c_ids, c, longest, turn, k, first: bool):
    """The k best candidates of a block for each query that can reach its floor."""
    dims = q.shape[1]
    head = max(1, dims // 4)
    qr, cr = q.astype(np.float64) @ turn, c.astype(np.float64) @ turn
    q_len, c_len = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_rest, c_rest = (np.linalg.norm(x[:, head:], axis=1) for x in (qr, cr))
    fits = float(q_len.max(initial=0)) * float(c_len.max(initial=0)) < 2.0 ** 52
    for i in range(0, len(q), QUERY_STEP):
        s = slice(i, i + QUERY_STEP)
        floor = floors[s] - SLACK * (q_len[s] * longest + 1)
        live = np.flatnonzero(first | (q_len[s] * longest >= floor))
        if not live.size:
            continue
        rows = i + live
        if first:
            cols = np.arange(len(c))
        else:
            # Candidates are sorted by falling length: those behind the last one that any query can use are out.
            need = float((floor[live] / np.maximum(q_len[rows], 1e-300)).min())
            end = int(np.searchsorted(-c_len, -need + SLACK * longest, side="right")) if need > 0 else len(c)
            bound = qr[rows, :head] @ cr[:end, :head].T + q_rest[rows, None] * c_rest[None, :end]
            cols = np.flatnonzero((bound >= floor[live, None]).any(0))
        if not cols.size:
            continue
        score = (q[rows].astype(np.float64) @ c[cols].astype(np.float64).T).astype(np.int64) if fits else q[rows] @ c[cols].T
        ok = c_ids[cols][None] != q_ids[rows, None]
        if not first:
            ok &= score >= floors[rows, None]
        for j, r in enumerate(rows):
            at = np.flatnonzero(ok[j])
            if at.size > k:
                cut = np.partition(score[j, at], at.size - k)[at.size - k]
                at = at[score[j, at] >= cut]
            best = np.lexsort((c_ids[cols[at]], -score[j, at]))[:k]
            for p in at[best]:
                yield int(q_ids[r]), int(c_ids[cols[p]]), int(score[j, p])


def _scored(tiles: DataFrame, dims: int, turn: np.ndarray, k: int, first: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q, floors, c_ids, c, longest in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                q_ids, c_ids = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                q, c = (np.frombuffer(x, np.int64).reshape(-1, dims) for x in (q, c))
                out = list(_tile(q_ids, q, np.frombuffer(floors), c_ids, c, longest, turn, k, first))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    return tiles.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, k: int = 20, every: int = 20, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows whose id is divisible by ``every``."""
    spark = df.sparkSession
    bound_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = written(_vectors(df, id_col, vec_col), "vectors")
    dims = max(vectors.agg(F.max("dims")).first()[0] or 0, 1)
    turn = _rotation(vectors, dims)
    longest_first = vectors.withColumn("floor", F.lit(0.0)).repartitionByRange(n, F.col("norm").desc(), "id").sortWithinPartitions(F.col("norm").desc(), "id")
    candidates, n_blocks = _numbered(written(_blocks(longest_first, CANDIDATES, dims), "candidates"), "cb")
    c = candidates.select("cb", F.col("ids").alias("c_ids"), F.col("vecs").alias("c"), F.col("longest").alias("c_longest"))

    def tiles(queries: DataFrame, number: int, which: DataFrame, first: int, last: int) -> DataFrame:
        # Blocks meet block by block: each side is repeated for the blocks of the other, a bounded
        # number of rows at a time, and dealt by the pair.
        q = queries.select("qb", F.col("ids").alias("q_ids"), F.col("vecs").alias("q"), "floors",
                           F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))).alias("cb"))
        both = which.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(number - 1).cast("bigint"))))
        return q.join(both, ["qb", "cb"]).select("q_ids", "q", "floors", "c_ids", "c", "c_longest")

    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    asked = vectors.where(F.pmod("id", F.lit(every)) == 0)
    start, q_blocks = _numbered(written(_blocks(asked.withColumn("floor", F.lit(0.0)).repartition(n, "id"), QUERIES, dims), "queries"), "qb")
    if not n_blocks or not q_blocks:
        return none
    found = written(_best(_scored(tiles(start, q_blocks, c.where("cb = 0"), 0, 0), dims, turn, k, True), k), "first")
    if n_blocks > 1:
        floors = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s")).where(F.col("c") >= k)
        floored = (asked.join(floors, asked["id"] == floors["query_id"], "left")
                   .withColumn("floor", F.coalesce(F.col("s").cast("double"), F.lit(float("-inf")))).select("id", "norm", "vec", "floor"))
        # Queries with like floors share a block, so a block of short candidates drops out for all of them.
        ranked = floored.repartitionByRange(n, F.col("floor") / F.greatest("norm", F.lit(1.0)), "id").sortWithinPartitions(F.col("floor") / F.greatest("norm", F.lit(1.0)), "id")
        asking, number = _numbered(written(_blocks(ranked, QUERIES, dims), "floored"), "qb")
        more = _scored(tiles(asking, number, c.where("cb > 0"), 1, n_blocks - 1), dims, turn, k, False)
        found = _best(found.select("query_id", "vec_id", "score").unionByName(more), k)
    return found.select("query_id", "rank", "vec_id", "score")
