"""Helpers of the vector searches: vectors out of Arrow lists, one row for each id, and sets of queries
in rounds of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Bytes of the queries that are sent to the executors at once.
ROUND_BYTES = 64 << 20


def finite_rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, vector)`` for the rows of an array<double> column that are not null and hold neither null nor
    non-finite components."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(ok):
        yield int(i), flat[offsets[i]:offsets[i + 1]]


def one_per_id(rows: DataFrame, *values: str) -> DataFrame:
    """One row for each id: of several different ones, the one with the smallest ``values``."""
    least = rows.groupBy("id").agg(F.min(F.struct(*values)).alias("v"))
    return least.select("id", *[F.col(f"v.{c}").alias(c) for c in values])


def rounds(queries: DataFrame, key: str, size: str) -> Iterator[list[Row]]:
    """The rows of ``queries`` in rounds of about ROUND_BYTES, dealt by a hash of ``key``; ``size`` is the column
    that counts."""
    total = queries.agg(F.sum(F.octet_length(size) + 64)).first()[0] or 0
    n = math.ceil(total / ROUND_BYTES)
    for i in range(n):
        part = queries.where(F.pmod(F.xxhash64(key), F.lit(n)) == i).collect()
        if part:
            yield part
