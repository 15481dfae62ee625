"""Session helpers: the settings our jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes.  Shuffle partition counts and memory belong to the
# cluster; we only switch on runtime re-planning (coalescing, skew splitting and
# broadcast conversion from measured sizes) and pin the session time zone.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "healthmart", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, pass the cluster's master and sizes."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(JOB_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    A temporary folder is only chosen when the session has no setting and runs on one machine
    (a ``local`` master, as in tests); on a cluster a missing setting is an error, because executors
    would write to disks the others cannot see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder shared by all executors (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="healthmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Bytes that a task of ``small_tasks`` reads of files and of shuffles, about (sorted and counted, shuffled rows
#: take some 40 times as much memory), and the partitions that its shuffles start from before small ones are put
#: together: no more than Spark writes without a sort.
SCAN_BYTES, TASK_BYTES, TASKS = 16 << 20, 8 << 20, 200


def _size(text: str) -> int:
    """A size as Spark's settings state it."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside read about ``SCAN_BYTES`` of files and ``TASK_BYTES`` of shuffles a task, so a task's
    memory hardly grows with the input.  With Spark's own settings few partitions, or few cores, put a growing
    share into each task.  Only jobs that run inside are meant, not frames that are built here and run later."""
    scan, shuffle = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in (scan, shuffle, number)}
    for k, size in ((scan, SCAN_BYTES), (shuffle, TASK_BYTES)):
        spark.conf.set(k, str(min(_size(spark.conf.get(k)), size)))
    spark.conf.set(number, str(max(int(before[number] or 0), int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS)))
    try:
        yield
    finally:
        for k, value in before.items():
            if value is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, value)
