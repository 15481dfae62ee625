"""K1: dense surrogate keys start, start + 1, ... in a stated order, without a single-partition sort of
big data.

Rows are range-partitioned and sorted by the order columns, then by all other columns, so ids are a
function of the rows at any size and partitioning; rows equal in every column are interchangeable,
and their place in the input splits them across range partitions.  Each row's partition and position
are recorded in a written table (in ``spark.checkpoint.dir``), whichever task attempt commits; the
id is the position plus the number of rows in the partitions before (a running sum over one row per
partition, which is also all that is broadcast).

Tables of a fixed domain (age buckets, gender codes, market segments, calendar years, a literal
change batch) state their largest size with ``at_most``: they are numbered by one window and marked for
broadcast, and a table that turns out larger raises instead of overflowing a task or an executor.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Largest sizes of the fixed domains (rows).
AGE_BUCKETS, GENDER_CODES, CONDITIONS, LOCATIONS, YEARS, CHANGE_BATCH = 8, 64, 1_000, 1_000, 10_000, 10_000


def _order(cols: Sequence[str | Column]) -> list[Column]:
    # PostgreSQL order: ascending, NULLs last.  Columns passed in keep their own direction.
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def scratch_root(spark) -> str:
    """This application's scratch folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/healthmart-tables/{spark.sparkContext.applicationId}"


def scratch_path(spark, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def scratch_namespace(spark, purpose: str) -> str:
    """Make a Spark database of its own below the scratch folder and return its name.  Nothing that another
    run, session or driver left in the warehouse can be in its way, and no other run replaces its tables."""
    namespace = f"{purpose}_{_app(spark)}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{namespace}` LOCATION '{scratch_path(spark, purpose)}'")
    return namespace


def _app(spark) -> str:
    return re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()


def release_scratch(spark) -> None:
    """Delete this application's scratch tables and namespaces.  For the owner of a finished job: frames that
    still read them fail afterwards."""
    for name in [r[0] for r in spark.sql("SHOW DATABASES").collect()]:
        if re.fullmatch(rf"\w+_{_app(spark)}_[0-9a-f]{{32}}", name):
            spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame, tag: str = "frozen") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (one job; cuts lineage)."""
    path = scratch_path(df.sparkSession, tag)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed_domain(df: DataFrame, at_most: int) -> DataFrame:
    """A table of at most ``at_most`` rows by its meaning, numbered 1.. in ``_nth`` by all columns and
    marked for broadcast.  One more row raises when the table is read."""
    nth = F.row_number().over(Window.orderBy(*_order(df.columns)))
    checked = F.when(F.col("_nth") <= at_most, F.col("_nth")).otherwise(
        F.raise_error(F.lit(f"a fixed domain of at most {at_most} rows holds more")).cast("int"))
    return F.broadcast(df.limit(at_most + 1).withColumn("_nth", nth).withColumn("_nth", checked))


def with_dense_id(df: DataFrame, order_cols: Sequence[str | Column], name: str, *,
                  at_most: int | None = None, start: int = 1) -> DataFrame:
    """Add ``name`` = start, start + 1, ... following ``order_cols``; ties are broken by the remaining
    columns.  ``at_most`` states the size of a fixed domain (see the module text)."""
    order = _order(order_cols)
    named = {c for c in order_cols if isinstance(c, str)}
    total = order + [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    if at_most is not None:
        nth = F.row_number().over(Window.orderBy(*total))
        over = F.raise_error(F.lit(f"{name}: a fixed domain of at most {at_most} rows holds more")).cast("long")
        numbered = df.limit(at_most + 1).withColumn("_nth", nth)
        return F.broadcast(numbered.withColumn(name, F.when(F.col("_nth") <= at_most, F.col("_nth").cast("long") + (start - 1))
                                               .otherwise(over)).drop("_nth"))
    total = total + [F.col("_tie").asc()]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*total).sortWithinPartitions(*total)
    return with_place(ranged.drop("_tie"), name, start=start)


def with_place(df: DataFrame, name: str, *, start: int = 1) -> DataFrame:
    """Add ``name`` = start, start + 1, ... in the order in which ``df`` delivers its rows, which an
    ordered read states with ``orderBy``."""
    placed = freeze(df.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)), "keys")
    # One row per partition: their running sum is one small task, and no job of its own.
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    off = F.broadcast(counts.select("_pid", (F.coalesce(before, F.lit(0)) + start).alias("_offset")))
    return placed.join(off, "_pid", "inner").withColumn(name, (F.col("_offset") + F.col("_pos")).cast("long")) \
        .drop("_pid", "_pos", "_offset")
