"""Hard negatives by a vertical scan of columns with shrinking candidate bitmaps (BOND).

Vectors are integers, ``floor(scale x)``, kept in blocks of columns: one array for each dimension, with its
smallest and largest value in the block.  An anchor reads the dimensions in the order of its own falling
magnitudes.  After every few dimensions a candidate's score lies between its partial sum plus the least and
plus the greatest that the remaining dimensions can still add (from the column's extremes), and candidates
whose interval has left what is still looked for drop out of the bitmap.  What remains at the end has its
exact integer score.

Two scans of the table, one after the other: the first finds each anchor's positives (interval below the
worst of the best so far: out), the second the negatives inside the score windows that the positives set
(interval outside all windows, or below what a full window already holds: out).  Blocks stay where they are
and are ordered by label, so the first scan opens only those of the anchor's label; the anchors travel, in
rounds of bounded size.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part,
nor do vectors whose integer length reaches 2 ** 31.5 (their scores need not fit 64 bits); an empty vector
and a shorter one count as padded with zeros; of several rows of one id the one with the smallest (label,
vector) counts; a positive with a negative score has an empty window; equal scores go to the smaller id;
positives with equal scores have the same negatives; an anchor without positives or without negatives in
its windows has no rows; empty tables give empty tables; only the named columns are read, so others cannot
clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, written
from .vectors import finite_rows, one_per_id, rounds

#: Rows of a block of columns; dimensions that are read between two looks at the bounds.
BLOCK, STEP = 8192, 8
#: Longest integer vector: by Cauchy-Schwarz its scores fit 64 bits.
LONGEST = 2.0 ** 31.5
BLOCKS = "ids binary, labels array<string>, codes binary, dims int, width int, cols binary"
POSITIVES = "anchor_id bigint, vec_id bigint, score bigint"
NEGATIVES = "anchor_id bigint, positive_score bigint, vec_id bigint, score bigint"


def _vectors(df: DataFrame, id_col: str, label: Column, vec_col: str, scale: int) -> DataFrame:
    """``(id, label, vec)``: labels as text, integer vectors as bytes without trailing zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vecs = [], []
            for i, x in finite_rows(batch.column(2)):
                with np.errstate(over="ignore"):
                    a = np.floor(scale * x)
                    if float((a * a).sum()) < LONGEST ** 2:
                        at.append(i)
                        vecs.append(np.trim_zeros(a, "b").astype(np.int64).tobytes())
            kept = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), pa.array(vecs, pa.binary())], ["id", "label", "vec"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
    return one_per_id(rows.mapInArrow(run, "id bigint, label string, vec binary"), "label", "vec")


def _blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of columns over the rows by label and id."""
    rows_at_once = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            vecs = [np.frombuffer(r[2], np.int64) for r in rows]
            x = np.zeros((max(len(v) for v in vecs), len(rows)), np.int64)
            for i, v in enumerate(vecs):
                x[:len(v), i] = v
            labels = sorted({r[1] for r in rows})
            code = {label: i for i, label in enumerate(labels)}
            top = int(np.abs(x).max(initial=0))
            width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([np.array([r[0] for r in rows], np.int64).tobytes()], pa.binary()), pa.array([labels], pa.list_(pa.string())),
                 pa.array([np.array([code[r[1]] for r in rows], np.int32).tobytes()], pa.binary()), pa.array([len(x)], pa.int32()),
                 pa.array([width], pa.int32()), pa.array([x.astype(f"i{width}").tobytes()], pa.binary())],
                ["ids", "labels", "codes", "dims", "width", "cols"])

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(held) >= rows_at_once:
                yield block(held[:rows_at_once])
                held = held[rows_at_once:]
        if held:
            yield block(held)

    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return vectors.select("id", "label", "vec").repartitionByRange(n, "label", "id").sortWithinPartitions("label", "id").mapInArrow(run, BLOCKS)


class _Block:
    """A block of columns as a task reads it."""

    def __init__(self, ids: bytes, labels: list[str], codes: bytes, dims: int, width: int, cols: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.code = {label: i for i, label in enumerate(labels)}
        self.codes = np.frombuffer(codes, np.int32)
        self.cols = np.frombuffer(cols, f"i{width}").reshape(dims, len(self.ids))
        self.low = self.cols.min(1, initial=0).astype(np.int64) if dims else np.zeros(0, np.int64)
        self.high = self.cols.max(1, initial=0).astype(np.int64) if dims else np.zeros(0, np.int64)

    def scan(self, anchor: np.ndarray, live: np.ndarray, wanted, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``live`` that ``wanted(least, greatest)`` lets through to the end, with their scores."""
        a = anchor[:len(self.cols)]
        order = np.argsort(-np.abs(a), kind="stable")[:np.count_nonzero(a)]
        a = a[order]
        ends = np.sort(np.stack([a * self.low[order], a * self.high[order]]).astype(np.float64), axis=0)
        # What the dimensions from the j-th on can add at least and at most.
        least, greatest = (np.concatenate([np.cumsum(e[::-1])[::-1], [0.0]]) for e in ends)
        slack = 1e-12 * float(np.abs(ends).sum())
        rows = np.flatnonzero(live)
        part = np.zeros(len(rows), np.int64)
        whole = len(rows) == len(live)
        for j, d in enumerate(order, 1):
            part += a[j - 1] * (self.cols[d] if whole else self.cols[d][rows])
            if j % step == 0 or j == len(order):
                keep = wanted(part + (least[j] - slack), part + (greatest[j] + slack))
                if not keep.all():
                    rows, part, whole = rows[keep], part[keep], False
                    if not rows.size:
                        break
        return rows, part


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


_NONE = np.zeros(0, np.int64)


def _positives(blocks: DataFrame, sent, k: int) -> DataFrame:
    """The k best rows of its own label in each task, for every anchor of the round."""
    step = STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_label = defaultdict(list)
        for r in sent.value:
            by_label[r["label"]].append((r["id"], np.frombuffer(r["vec"], np.int64)))
        best = defaultdict(lambda: (_NONE, _NONE))
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                b = _Block(*row)
                for label, code in b.code.items():
                    same = b.codes == code
                    for anchor, q in by_label.get(label, ()):
                        ids, scores = best[anchor]
                        floor = scores[-1] if len(scores) == k else -np.inf
                        at, s = b.scan(q, same & (b.ids != anchor), lambda least, greatest: greatest >= floor, step)
                        if at.size:
                            best[anchor] = _best(np.concatenate([ids, b.ids[at]]), np.concatenate([scores, s]), k)
        out = [(anchor, i, s) for anchor, found in best.items() for i, s in zip(*found)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["anchor_id", "vec_id", "score"])

    return blocks.mapInArrow(run, POSITIVES)


def _negatives(blocks: DataFrame, sent, k: int, percent: int) -> DataFrame:
    """The k best rows of other labels in each task, for every anchor of the round and every score of its positives."""
    step = STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for r in sent.value:
            for p in r["scores"]:
                best[r["id"], p] = _NONE, _NONE
        anchors = [(r["id"], r["label"], np.frombuffer(r["vec"], np.int64), r["scores"]) for r in sent.value]
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                b = _Block(*row)
                for anchor, label, q, tops in anchors:
                    code = b.code.get(label, -1)
                    if len(b.code) == 1 and code == 0:
                        continue
                    # A window is [percent of the positive's score, that score]; a full one starts at its worst.
                    lows = [int(best[anchor, p][1][-1]) if len(best[anchor, p][1]) == k else -(-percent * p // 100) for p in tops]

                    def wanted(least, greatest, lows=lows, tops=tops):
                        keep = np.zeros(len(least), bool)
                        for low, top in zip(lows, tops):
                            keep |= (greatest >= low) & (least <= top)
                        return keep

                    at, s = b.scan(q, b.codes != code, wanted, step)
                    for low, p in zip(lows, tops):
                        inside = (s >= low) & (s <= p)
                        if inside.any():
                            ids, scores = best[anchor, p]
                            best[anchor, p] = _best(np.concatenate([ids, b.ids[at[inside]]]), np.concatenate([scores, s[inside]]), k)
        out = [(anchor, p, i, s) for (anchor, p), found in best.items() for i, s in zip(*found)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], ["anchor_id", "positive_score", "vec_id", "score"])

    return blocks.mapInArrow(run, NEGATIVES)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256, *,
         label: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for the anchors (ids divisible
    by ``every``) and each of their ``positives`` nearest rows of the same label, the first ``negatives`` rows of
    other labels whose score is at least ``percent`` hundredths of the positive's and not above it."""
    spark = df.sparkSession
    bound_batches(spark)
    vectors = written(_vectors(df, id_col, F.col("label") if label is None else label, vec_col, scale), "labelled")
    blocks = written(_blocks(vectors), "columns")
    out = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    for anchors in rounds(vectors.where(F.pmod("id", F.lit(every)) == 0), "id", "vec"):
        sent = spark.sparkContext.broadcast(anchors)
        near = written(_first(_positives(blocks, sent, positives), ["anchor_id"], positives), "positives")
        windows = near.where("score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_set("score")).alias("scores"))
        scores = {r["anchor_id"]: r["scores"] for r in windows.collect()}   # at most `positives` for an anchor of the round
        asked = spark.sparkContext.broadcast([{"id": r["id"], "label": r["label"], "vec": r["vec"], "scores": scores[r["id"]]}
                                              for r in anchors if r["id"] in scores])
        far = _first(_negatives(blocks, asked, negatives, percent), ["anchor_id", "positive_score"], negatives)
        pairs = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        out = out.unionByName(written(pairs.join(far, ["anchor_id", "positive_score"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    return out
