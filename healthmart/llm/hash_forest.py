"""Approximate nearest neighbours by cosine in a forest of sorted hash prefixes.

A tree gives each vector a long string of bits, the sides of orthogonal random hyperplanes through the mean
direction, and is the array of these strings in sorted order.  A query descends in every tree to the rows
that share its longest prefix, then all trees ascend together, one bit a step, until the rows that share a
prefix of the reached length with it number the budget, over all trees.  Rows under one prefix are
neighbours in the sorted array, so a query's candidates in a block are one slice.

The arrays are range-partitioned by (tree, string) and kept in blocks, with 8-bit codes of the vectors
beside the strings.  Blocks stay where they are; the queries travel, in rounds of bounded size.  One pass
counts the rows under each prefix length and fixes where the ascent ends; the next scores the slices by
their codes and keeps the rows that the codes' error bounds cannot rule out of the nearest.  Those are
scored exactly, on the original vectors.

Vectors that are equal (up to a power of two) form one class: classes are indexed and scored once, and a
class stands for its members of smallest id, one more than a query returns, which is all that any result
can hold.  Every class is indexed.  The mean is fitted on at most SAMPLE classes, those with the smallest
hashed numbers.  The budget is a share of the classes, so recall does not fall as the table grows, and at
least LEAST classes a tree, so that small tables are searched nearly whole.

Defined results: vectors that are null, zero or hold null or non-finite components take no part, nor do rows
with a null id; a shorter vector counts as padded with zeros; of several vectors of one id the smallest (by
its bytes) counts; ties go to the smaller id; a query with fewer candidates than k gets all of them; empty
tables give empty tables; only the id and vector columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, written
from .vectors import finite_rows, one_per_id, rounds

#: Trees, bits of a string, seed of the hyperplanes.
TREES, BITS, SEED = 24, 48, 42
#: The trees together must offer this share of the classes, and this many on average from each.
SHARE, LEAST = 0.6, 64
#: Classes that the mean is fitted on, at most; rows of a block.
SAMPLE, BLOCK = 10_000, 8192
BLOCKS = "tree int, keys binary, cls binary, codes binary, scales binary, errors binary"
#: Rounding of 32-bit sums over codes.
ROUNDING = 1e-5


def _pack(x: np.ndarray) -> bytes:
    """The vector times a power of two that brings its greatest component below 1, without trailing zeros: in 32
    bits where that loses nothing, else in 64."""
    x = np.trim_zeros(np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) + 0.0, "b")
    with np.errstate(under="ignore"):
        short = x.astype(np.float32)
    return b"\x04" + short.tobytes() if (short == x).all() else b"\x08" + x.tobytes()


def _unpack(vecs: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(vecs), dims))
    for i, v in enumerate(vecs):
        a = np.frombuffer(v, f"f{v[0]}", offset=1)
        out[i, :len(a)] = a
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(i, _pack(x)) for i, x in finite_rows(batch.column(1)) if x.any()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i for i, _ in kept], pa.int64())), pa.array([v for _, v in kept], pa.binary())], ["id", "vec"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return one_per_id(rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).mapInArrow(run, "id bigint, vec binary"), "vec")


def _classes(vectors: DataFrame, members: int) -> DataFrame:
    """``(cls, vec, ids)``: equal vectors once, with their ``members`` smallest ids."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = vectors.withColumn("nth", nth).where(F.col("nth") <= members)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("cls", F.monotonically_increasing_id())


def _hyperplanes(trees: int, bits: int, dims: int) -> np.ndarray:
    """``bits`` unit normals for each tree, orthogonal in groups of ``dims``."""
    rng = np.random.default_rng(SEED)
    out = [np.concatenate([np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(-(-bits // dims))])[:bits] for _ in range(trees)]
    return np.stack(out)


def _keys(x: np.ndarray, mean: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The strings of unit vectors as integers, a column for each tree; the first bit is the highest."""
    powers = 2.0 ** np.arange(planes.shape[1] - 1, -1, -1)
    return np.stack([(((x - mean) @ p.T) > 0) @ powers for p in planes], axis=1).astype(np.int64)


def _forest(classes: DataFrame, shared, dims: int) -> DataFrame:
    """The sorted arrays of all trees in blocks of one tree each."""
    rows_at_once = BLOCK

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, planes = shared.value
        for batch in batches:
            cls = batch.column(0)
            if not len(cls):
                continue
            x = _unpack(batch.column(1).to_pylist(), dims)
            x /= _lengths(x)[:, None]
            keys = _keys(x, mean, planes)
            scale = (np.abs(x).max(1) / 127).astype(np.float32)
            codes = np.rint(x / scale[:, None]).astype(np.int8)
            error = (_lengths(x - codes * scale[:, None].astype(np.float64)) * (1 + 1e-6)).astype(np.float32)
            entries = pa.array([c.tobytes() + s.tobytes() + e.tobytes() for c, s, e in zip(codes, scale, error)], pa.binary())
            for tree in range(len(planes)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), tree, np.int32)), pa.array(keys[:, tree]), cls, entries], ["tree", "key", "cls", "entry"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), dims + 8)
            parts = [np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), raw[:, :dims], raw[:, dims:dims + 4], raw[:, dims + 4:]]
            return pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                              ["tree", "keys", "cls", "codes", "scales", "errors"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (held[0][0] != row[0] or len(held) == rows_at_once):
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.select("cls", "vec").mapInArrow(hashed, "tree int, key bigint, cls bigint, entry binary")
    return rows.repartitionByRange(n, "tree", "key", "cls").sortWithinPartitions("tree", "key", "cls").mapInArrow(packed, BLOCKS)


def _slices(keys: np.ndarray, q: np.ndarray, shift: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where the rows that share all but the last ``shift`` bits with each query begin and end."""
    low = (q >> shift) << shift
    return np.searchsorted(keys, low), np.searchsorted(keys, low + (np.int64(1) << shift))


def _counted(forest: DataFrame, sent, bits: int) -> DataFrame:
    """Rows that share at least ``level`` bits with a query, over the trees of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value["keys"]
        total = np.zeros((len(asked), bits + 1), np.int64)
        for batch in batches:
            for tree, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, live = np.frombuffer(keys, np.int64), np.arange(len(asked))
                for level in range(bits + 1):
                    first, end = _slices(keys, asked[live, tree], bits - level)
                    total[live, level] += end - first
                    live = live[end > first]
                    if not live.size:
                        break
        query, level = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(level, pa.int32()), pa.array(total[query, level], pa.int64())], ["query", "level", "n"])

    return forest.select("tree", "keys").mapInArrow(run, "query bigint, level int, n bigint")


def _scored(forest: DataFrame, sent, members: int, bits: int, dims: int) -> DataFrame:
    """``(query, cls, least, greatest)``: the classes under each query's prefixes whose greatest possible cosine
    reaches the least of the ``members`` best of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, level, units = (sent.value[k] for k in ("keys", "levels", "units"))
        units = units.astype(np.float32)
        floor = np.full(len(asked), -np.inf)
        held: list[tuple | None] = [None] * len(asked)
        for batch in batches:
            for tree, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, cls, codes, scale, error = (np.frombuffer(p, t) for p, t in zip(parts, (np.int64, np.int64, np.int8, np.float32, np.float32)))
                codes = codes.reshape(-1, dims).astype(np.float32)
                error = error + np.float32(ROUNDING)
                first, end = _slices(keys, asked[:, tree], bits - level)
                for i in np.flatnonzero(end > first):
                    s = slice(first[i], end[i])
                    score = (codes[s] @ units[i]) * scale[s]
                    at = np.flatnonzero(score + error[s] >= floor[i])
                    if not at.size:
                        continue
                    new = cls[s][at], score[at].astype(np.float64), error[s][at].astype(np.float64)
                    if held[i] is not None:
                        new = tuple(np.concatenate(p) for p in zip(held[i], new))
                    # A class of several trees counts once.
                    _, once = np.unique(new[0], return_index=True)
                    c, mid, off = (p[once] for p in new)
                    if len(c) > members:
                        least = mid - off
                        floor[i] = np.partition(least, len(c) - members)[len(c) - members]
                        stay = mid + off >= floor[i]
                        c, mid, off = c[stay], mid[stay], off[stay]
                    held[i] = c, mid, off
        for i, rows in enumerate(held):
            if rows is not None:
                c, mid, off = rows
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), i, np.int64)), pa.array(c), pa.array(mid - off), pa.array(mid + off)], ["query", "cls", "least", "greatest"])

    return forest.mapInArrow(run, "query bigint, cls bigint, least double, greatest double")


def _exact(rows: DataFrame, sent, dims: int) -> DataFrame:
    """``(asked, vec_id, score)``: cosines of rows ``(query, vec, ids)``, for the members of their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = sent.value["cls"], sent.value["vecs"]
        lengths = _lengths(asked)
        for batch in batches:
            q = batch.column(0).to_numpy()
            x = _unpack(batch.column(1).to_pylist(), dims)
            score = (x * asked[q]).sum(1) / (_lengths(x) * lengths[q])
            yield pa.RecordBatch.from_arrays([pa.array(names[q]), batch.column(2), pa.array(score)], ["asked", "ids", "score"])

    out = rows.mapInArrow(run, "asked bigint, ids array<bigint>, score double")
    return out.select("asked", F.explode("ids").alias("vec_id"), "score")


def _top(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(df: DataFrame, k: int = 5, every: int = 50, *, trees: int = TREES, bits: int = BITS, share: float = SHARE,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows whose id is divisible by ``every``: the ``k`` nearest that the
    forest finds.  ``share`` of the classes is the budget at which the trees stop to ascend."""
    spark = df.sparkSession
    bound_batches(spark)
    members = k + 1     # a query's own row is dropped at the end
    vectors = written(_vectors(df, id_col, vec_col), "directions")
    classes = written(_classes(vectors, members), "direction-classes")
    n, widest = classes.agg(F.count(F.lit(1)), F.max((F.octet_length("vec") - 1) / F.ascii(F.substring("vec", 1, 1).cast("string")))).first()
    out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not n:
        return out
    dims = int(widest)
    sample = _unpack([r["vec"] for r in classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("vec").collect()], dims)
    mean, planes = (sample / _lengths(sample)[:, None]).mean(0), _hyperplanes(trees, bits, dims)
    forest = written(_forest(classes, spark.sparkContext.broadcast((mean, planes)), dims), "forest")
    own = vectors.where(F.pmod("id", F.lit(every)) == 0).join(classes.select("vec", "cls"), "vec").select(F.col("id").alias("query_id"), F.col("cls").alias("asked"))
    own = written(own, "asked")
    queries = classes.join(own.select(F.col("asked").alias("cls")).distinct(), "cls").select("cls", "vec")
    for part in rounds(queries, "cls", "vec"):
        vecs = _unpack([r["vec"] for r in part], dims)
        units = vecs / _lengths(vecs)[:, None]
        told = {"cls": np.array([r["cls"] for r in part], np.int64), "vecs": vecs, "units": units, "keys": _keys(units, mean, planes)}
        counts = _counted(forest, spark.sparkContext.broadcast(told), bits).groupBy("query", "level").agg(F.sum("n").alias("n"))
        # Every tree offers the query's own class.
        budget = trees + max(math.ceil(share * n), trees * max(k, LEAST))
        reached = counts.where(F.col("n") >= budget).groupBy("query").agg(F.max("level").alias("level")).collect()   # one row a query of the round
        told["levels"] = np.zeros(len(part), np.int64)
        told["levels"][[r["query"] for r in reached]] = [r["level"] for r in reached]
        sent = spark.sparkContext.broadcast(told)
        kept = _scored(forest, sent, members, bits, dims).groupBy("query", "cls").agg(F.max("least").alias("least"), F.max("greatest").alias("greatest"))
        nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("least").desc(), "cls"))
        floor = F.max(F.when(F.col("nth") == members, F.col("least"))).over(Window.partitionBy("query"))
        kept = kept.withColumn("nth", nth).withColumn("floor", floor).where(F.col("floor").isNull() | (F.col("greatest") >= F.col("floor")))
        found = _top(_exact(kept.select("query", "cls").join(classes, "cls").select("query", "vec", "ids"), sent, dims), "asked", members)
        mine = own.join(found.select("asked", "vec_id", "score"), "asked").where(F.col("vec_id") != F.col("query_id"))
        out = out.unionByName(written(_top(mine, "query_id", k).select("query_id", "rank", "vec_id", "score"), "nearest"))
    return out
