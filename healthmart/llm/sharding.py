"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that must stay together.  Groups, sorted by falling size, go to
the least-loaded shard through a heap.  Groups of equal size are interchangeable, so what is
scheduled is the histogram of sizes: of the ``n`` groups of one size all but the last few are dealt at
once by levelling the loads, the rest one by one through the heap, which gives the loads of the plain
schedule over all groups.  A group then finds its shard by its rank within its size.

The driver holds one row per distinct size.  ``k`` distinct sizes need at least ``k * k / 2`` bytes of
text, so there are at most the square root of twice the bytes: 245,000 for 30 GB.

Ranks and slots are numbered in chunks (rows dealt by a hash) whose offsets are summed, so no task
orders a whole shard or all groups of a frequent size.  Groups with at least ``1 / HOT`` of the rows,
of which there are at most ``HOT``, are broadcast to their rows; the others meet them in a shuffle.

Defined results: a null text has size 1 and CRC 0, and all null texts are one group, distinct from
the empty text; repeated rows and ties are rows of their group like any other; null ids are allowed;
an empty table gives an empty table; only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Groups with at least this part of all rows are broadcast.
HOT = 1_000
#: Rows that share one chunk of a shard, or groups that share one of a size, about.
CHUNK_ROWS = 1 << 16


def schedule(sizes: Iterable[tuple[int, int]], n_shards: int) -> Iterator[list[int]]:
    """LPT over ``(size, number of groups)`` by falling size: for each size, how many of its groups
    go to each shard.  Every group goes to the shard with the least load, the first of equals."""
    loads = [0] * n_shards
    for size, n in sizes:
        given = [0] * n_shards
        if n > n_shards:
            for s, g in enumerate(_level(loads, size, n)):
                given[s] = g
                loads[s] += g * size
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(n - sum(given)):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + size, s))
            given[s] += 1
            loads[s] += size
        yield given


def _level(loads: list[int], size: int, n: int) -> list[int]:
    """Groups that each shard gets for sure: those that meet a load one ``size`` below the level at
    which ``n`` groups would fill the emptiest shards evenly.  LPT places them before all others."""
    held, total = 0, n * size
    for k, load in enumerate(sorted(loads), 1):
        if k > 1 and load * (k - 1) >= held + total:
            break
        held += load
        level = (held + total) // k
    return [max(0, -(-(level - size - load) // size)) for load in loads]


def shard(df: DataFrame, n_shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` of each row of ``df``."""
    text = F.col(text_col)
    # The texts are read once; everything else works on this narrow table.
    rows = written(df.select(F.col(id_col).alias("row_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                             F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("crc"),
                             F.coalesce(F.sha2(text, 256), F.lit("null")).alias("key")), "shard-rows")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    n_groups, n_rows = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    placed = written(_placed(groups, n_shards, int(n_groups)), "shard-placed")
    hot = F.col("n") * HOT >= F.lit(int(n_rows))
    at_hot = rows.join(F.broadcast(placed.where(hot).select("key", "shard")), "key", "left")
    rest = at_hot.where(F.col("shard").isNull()).drop("shard").join(placed.where(~hot).select("key", "shard"), "key")
    rows = written(at_hot.where(F.col("shard").isNotNull()).unionByName(rest), "shard-members")
    # A chunk of a shard is one task's work.
    chunks = max(1, -(-int(n_rows) // (n_shards * CHUNK_ROWS)))
    out = _ranked(rows.withColumn("chunk", F.pmod(F.xxhash64("key", "row_id"), F.lit(chunks).cast("long"))),
                  "shard", ["row_id", "key"], "slot")
    return out.select(F.col("row_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def _placed(groups: DataFrame, n_shards: int, n_groups: int) -> DataFrame:
    """``groups`` with their shards."""
    sizes = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups")).toArrow().sort_by([("bytes", "descending")])
    given = schedule(zip(sizes["bytes"].to_pylist(), sizes["groups"].to_pylist(), strict=True), n_shards)
    ends = []
    for counts in given:
        end = 0
        ends.append([end := end + c for c in counts])
    dealt = groups.sparkSession.createDataFrame(
        pa.table({"bytes": sizes["bytes"].cast(pa.int64()), "ends": pa.array(ends, pa.list_(pa.int64()))}))
    chunks = max(1, -(-n_groups // CHUNK_ROWS))
    ranked = _ranked(groups.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks).cast("long"))), "bytes", ["key"], "rank")
    # The shard is the first whose groups of this size end behind the rank.
    return ranked.join(dealt, "bytes").select(
        "key", "n", F.size(F.filter("ends", lambda end: end <= F.col("rank"))).alias("shard"))


def _ranked(rows: DataFrame, of: str, order: list[str], name: str) -> DataFrame:
    """``rows`` numbered from 0 within ``of``, by their ``chunk`` and then by ``order``."""
    counts = rows.groupBy(of, "chunk").agg(F.count(F.lit(1)).alias("members"))
    before = Window.partitionBy(of).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(of, "chunk", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(of, "chunk").orderBy(*order)
    return (rows.withColumn("at", F.row_number().over(inside) - 1).join(offsets, [of, "chunk"])
            .withColumn(name, (F.col("offset") + F.col("at")).cast("long")).drop("at", "offset"))
