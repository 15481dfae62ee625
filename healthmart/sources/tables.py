"""Sources and sinks: typed loads (A2), scans (A3), rebuilds (A4), namespaces (A5), inserts
from a query (A6) and literal rows (A7)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import CHAR_COLUMNS, DEFAULTS, SCHEMAS


def conform(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None,
            char_cols: Iterable[str] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns become NULL (then their default), present
    ones are cast (ANSI: a malformed value raises), CHAR columns lose their pad blanks."""
    defaults = defaults or {}
    char_cols = set(char_cols)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in char_cols:
            c = F.rtrim(c.cast("string"))
        c = c.cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
         options: Mapping[str, str] | None = None) -> DataFrame:
    """A2: read an operational table with its declared schema (no inference), applying column
    defaults and CHAR trimming.  Text formats are read as strings and cast by column name."""
    schema = SCHEMAS[table]
    reader = spark.read.options(**(options or {}))
    if fmt == "parquet":
        raw = reader.parquet(path)
    elif fmt == "csv":
        # Columns are matched by header name, read as text (no inference) and cast by ``conform``;
        # a file may carry only some of the columns, as an INSERT with a column list does.
        raw = reader.option("header", "true").option("inferSchema", "false").csv(path)
    else:
        raw = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])) \
            .format(fmt).load(path)
    return conform(raw, schema, DEFAULTS.get(table), CHAR_COLUMNS.get(table, ()))


#: Table property that names a table's version.
VERSION = "healthmart.version"


class Catalog:
    """A5: one namespace (Spark database) of tables.

    Tables are managed Parquet tables in the session catalog, so a cluster keeps them in its
    shared warehouse folder.  ``replace`` is the drop-and-rebuild of A4; when the new content
    is computed from the table it replaces, the content is first cut from its lineage with a
    reliable checkpoint so the old files are never read while being overwritten.
    """

    def __init__(self, spark: SparkSession, namespace: str):
        self.spark = spark
        self.namespace = namespace
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")

    def name(self, table: str) -> str:
        return f"`{self.namespace}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def scan(self, table: str) -> DataFrame:
        """A3."""
        return self.spark.table(self.name(table))

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """A4: drop-and-rebuild; rerunning gives the same state.  The new version is written beside the
        table and takes its name when it is complete; until then readers, ``df`` itself among them,
        see the old version, and a failed write leaves it in place."""
        return self.replace_all({table: df})[table]

    def replace_all(self, frames: Mapping[str, DataFrame], partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
        """Replace several tables in one swap: all new versions are written first, and only when every one is
        complete do they take the names.  A failed write leaves all tables as they were.  A driver that
        dies between two renames leaves both versions behind, and ``recover`` finishes the swap."""
        version = uuid.uuid4().hex
        try:
            for table, df in frames.items():
                by = (partition_by or {}).get(table, ())
                df.write.format("parquet").partitionBy(*by).saveAsTable(self.name(f"{table}__new_{version}"))
                self.spark.sql(f"ALTER TABLE {self.name(f'{table}__new_{version}')} SET TBLPROPERTIES ('{VERSION}' = '{version}')")
        except BaseException:
            for table in frames:
                self.drop(f"{table}__new_{version}")
            raise
        # Tables that exist go first: an old version that was moved away shows that all new ones are complete.
        for table in sorted(frames, key=lambda t: not self.exists(t)):
            self._swap(table, version)
        for table in frames:
            self.drop(f"{table}__old_{version}")
        return {table: self.scan(table) for table in frames}

    def _swap(self, table: str, version: str) -> None:
        if self.exists(table) and not self.exists(f"{table}__old_{version}"):
            self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {self.name(f'{table}__old_{version}')}")
        self.spark.sql(f"ALTER TABLE {self.name(f'{table}__new_{version}')} RENAME TO {self.name(table)}")
        self._relocate_partitions(table)

    def _relocate_partitions(self, table: str) -> None:
        """A catalog may keep a partition's folder under the name that the table had before."""
        info = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        if not any(r["col_name"] == "# Partition Information" for r in info):
            return
        home = next(r["data_type"] for r in info if r["col_name"] == "Location").rstrip("/")
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect():
            spec = [part.split("=", 1) for part in r["partition"].split("/")]
            values = ", ".join(f"`{k}` = NULL" if v == "__HIVE_DEFAULT_PARTITION__" else "`{}` = '{}'".format(k, unquote(v).replace("'", "\\'")) for k, v in spec)
            self.spark.sql(f"ALTER TABLE {self.name(table)} PARTITION ({values}) SET LOCATION '{home}/{r['partition']}'")
        self.spark.catalog.refreshTable(self.name(table))

    def recover(self) -> None:
        """After a driver died in ``replace_all`` (for the namespace's only writer): a swap that had begun is
        finished, new versions whose swap had not begun are dropped."""
        left = [(m[1], m[2], m[3]) for t in self.spark.catalog.listTables(self.namespace) if not t.isTemporary
                and (m := re.fullmatch(r"(.+)__(new|old)_([0-9a-f]{32})", t.name))]
        begun = {version for _, kind, version in left if kind == "old"}
        for table, kind, version in left:
            if kind == "new" and version in begun:
                self._swap(table, version)
            elif kind == "new":
                self.drop(f"{table}__new_{version}")
        for table, kind, version in left:
            if kind == "old":
                self.drop(f"{table}__old_{version}")

    def overwrite_partitions(self, table: str, df: DataFrame, by: Sequence[str]) -> None:
        """Replace the partitions of a table that ``df`` has rows of and leave the others' files alone.  The rows
        are staged first, so ``df`` may be computed from the table.  A table that does not exist is made."""
        if not self.exists(table):
            self.replace_all({table: df}, {table: by})
            return
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            df.select(*self.scan(table).columns).write.mode("overwrite").insertInto(self.name(table))
        finally:
            self.spark.conf.set(mode, before)
        self.spark.catalog.refreshTable(self.name(table))

    def version(self, table: str) -> str | None:
        """The version that ``replace`` gave the table; it changes with every replacement."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return next((r["value"] for r in rows if r["key"] == VERSION), None)

    def append(self, table: str, df: DataFrame, cols: Sequence[str] | None = None) -> None:
        """INSERT INTO table (cols) SELECT ... - by column name; absent columns get NULL."""
        target = self.scan(table).schema
        src = df.select(*cols) if cols else df
        conform(src, target).write.mode("append").format("parquet").saveAsTable(self.name(table))

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")


def append_rows(spark: SparkSession, df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Union literal rows (partial column lists allowed) onto ``df``.  Values are cast to the
    target types explicitly, so '9' lands in an integer column (and 'x' raises)."""
    names = sorted({k for r in rows for k in r})
    text = spark.createDataFrame([[None if r.get(n) is None else str(r.get(n)) for n in names] for r in rows],
                                 T.StructType([T.StructField(n, T.StringType()) for n in names]))
    cast = text.select(*[F.col(n).cast(df.schema[n].dataType).alias(n) for n in names])
    return df.unionByName(cast, allowMissingColumns=True)
