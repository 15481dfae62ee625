"""Shared helpers: table reads, shared scratch tables and bounded Arrow batches."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

#: ASCII white space of every word rule here: space and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of one Arrow batch: long documents never pile up in a Python worker.
BATCH_ROWS, BATCH_BYTES = 2_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once a session), so that they need no installation."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_shipped_package", None) == str(package) or not package.is_dir():
        return
    path = os.path.join(tempfile.mkdtemp(prefix=f"{package.name}-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(path)
    sc._shipped_package = str(package)


def bound_batches(spark: SparkSession) -> None:
    """Before Python runs on executors: send them this package, and bound what one Arrow batch hands
    over, by rows and by bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_in_use = None


def take_turn(holder) -> None:
    """``holder`` keeps caches for the tasks to come; those of the holder before it are emptied by its ``forget``.
    A Python worker serves the tasks of all operators: without this it would keep what each of them left."""
    global _in_use
    if _in_use is not holder:
        if _in_use is not None:
            _in_use.forget()
        _in_use = holder


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a written table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, when all that reads them has been written itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.  It does so when the driver's garbage
    collection finds their plans unused, which a long chain of written tables would otherwise wait for."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
