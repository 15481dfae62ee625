"""A10: enrich rows on arrival with a looked-up column - the reference's BEFORE INSERT trigger.

The same function serves a batch DataFrame and a streaming one (stream-static left join).  A stream whose
lookup changes while it runs uses ``run_arrivals_as_of``: every micro-batch takes the lookup's version of that
moment and is written once.  Semantics of the trigger: the looked-up value *replaces* whatever
the arriving row carried; no match gives NULL and the row is kept; later changes to the
lookup table are not propagated to rows already stored (the lookup is as of arrival).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import assert_unique
from ..session import ensure_checkpoint_dir
from ..sources.tables import Catalog


def enrich_on_arrival(df: DataFrame, lookup: DataFrame, on: tuple[str, str], cols: Sequence[str],
                      *, check: bool = True) -> DataFrame:
    """Attach ``cols`` from ``lookup`` where ``df[on[0]] == lookup[on[1]]`` (left join)."""
    left_key, right_key = on
    if check:
        lookup = assert_unique(lookup, [right_key], "arrival lookup")
    lk = lookup.select(F.col(right_key).alias("_lk"), *cols)
    keep = [c for c in df.columns if c not in cols]
    out = df.select(*keep).join(lk, F.col(left_key) == F.col("_lk"), "left").drop("_lk")
    order = [c for c in df.columns] + [c for c in cols if c not in df.columns]
    return out.select(*order)


def stream_folder(spark: SparkSession, sub: str) -> str:
    """A fresh folder under the shared checkpoint location (never a machine-local temp dir)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/healthmart-streams/{sub}-{uuid.uuid4().hex}"


def run_arrivals(spark: SparkSession, source: str, schema: T.StructType, lookup: DataFrame,
                 on: tuple[str, str], cols: Sequence[str], out_path: str | None = None,
                 max_files_per_trigger: int | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Drive the enrichment as a Structured Streaming query over the files at ``source``.

    ``prepare`` turns the arriving rows into the rows to enrich (stream-static joins allowed).
    Runs with ``availableNow`` (all present files, in micro-batches, then stop) into a Parquet
    sink with its own checkpoint, so a restart resumes where it stopped and no row is written
    twice.  Returns the sink's content as a batch DataFrame.
    """
    out_path = out_path or stream_folder(spark, "arrivals-out")
    ckpt = out_path.rstrip("/") + "-checkpoint"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    if prepare is not None:
        stream = prepare(stream)   # e.g. arriving line items -> outcome rows
    enriched = enrich_on_arrival(stream, lookup, on, cols)
    q = (enriched.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(enriched.schema).parquet(out_path)


class CatalogLookup:
    """The current version of a catalog table as an arrival lookup.  That its key identifies one row is checked
    once for each version, not for each micro-batch."""

    def __init__(self, cat: Catalog, table: str, key: str):
        self.cat, self.table, self.key = cat, table, key
        self.checked: str | None = None

    def __call__(self) -> DataFrame:
        version, frame = self.cat.version(self.table), self.cat.scan(self.table)
        if version is None or version != self.checked:
            assert_unique(frame, [self.key], "arrival lookup")
            self.checked = version
        return frame


def _committed(spark: SparkSession, folder: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_arrivals_as_of(arrived: DataFrame, batch_id: int, lookup: Callable[[], DataFrame], on: tuple[str, str],
                         cols: Sequence[str], out_path: str) -> None:
    """One micro-batch of the trigger: enrich with the lookup as it is now, and write the batch's own folder.  A batch
    that was committed before keeps what it got then; one that broke off is written anew."""
    folder = f"{out_path.rstrip('/')}/batch_id={batch_id}"
    if not _committed(arrived.sparkSession, folder):
        enrich_on_arrival(arrived, lookup(), on, cols, check=False).write.mode("overwrite").parquet(folder)


def run_arrivals_as_of(spark: SparkSession, source: str, schema: T.StructType, lookup: Callable[[], DataFrame], on: tuple[str, str],
                       cols: Sequence[str], out_path: str, max_files_per_trigger: int | None = None,
                       prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The trigger over a lookup that changes: rows keep the values of the lookup at their arrival.

    All files that are present at ``source`` arrive, in micro-batches; the next call with the same ``out_path``
    goes on with those that came since.  ``lookup()`` is asked once for each micro-batch.  Every batch is a folder
    of its own under ``out_path``, so a batch that is run again after a failure adds no row.  Returns the
    sink's content as a batch DataFrame."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    if prepare is not None:
        stream = prepare(stream)
    q = (stream.writeStream.foreachBatch(lambda df, i: write_arrivals_as_of(df, i, lookup, on, cols, out_path))
         .option("checkpointLocation", out_path.rstrip("/") + "-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    found = lookup().schema
    names = stream.columns + [c for c in cols if c not in stream.columns]
    fields = [T.StructField(c, found[c].dataType if c in cols else stream.schema[c].dataType) for c in names]
    return spark.read.schema(T.StructType([*fields, T.StructField("batch_id", T.LongType())])).parquet(out_path).drop("batch_id")
