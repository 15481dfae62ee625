"""Integrity as data (A8, A9): rule violations, orphaned foreign keys and duplicate keys are
returned as DataFrames, never by collecting rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_rules(df: DataFrame, defaults: Mapping[str, object] | None = None,
                not_null: Sequence[str] = (), max_len: Mapping[str, int] | None = None,
                key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Column defaults, NOT NULL and VARCHAR(n) limits.

    Returns (rows with defaults applied, violations).  Violations are one row per broken rule:
    the row's ``key`` columns, the column, the rule and the offending length.
    """
    defaults = defaults or {}
    max_len = max_len or {}
    ok = df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                     if c in defaults else F.col(c) for c in df.columns])
    checks = []
    for c in not_null:
        checks.append(F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column_name"), F.lit("not null").alias("rule"),
                                                         F.lit(None).cast("long").alias("length"))))
    for c, n in max_len.items():
        ln = F.length(F.col(c).cast("string")).cast("long")
        checks.append(F.when(ln > n, F.struct(F.lit(c).alias("column_name"), F.lit(f"max length {n}").alias("rule"),
                                              ln.alias("length"))))
    if not checks:
        return ok, ok.limit(0)
    bad = ok.select(*key, F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("v")) \
        .select(*key, "v.column_name", "v.rule", "v.length")
    return ok, bad


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, label: tuple[str, str, str, str]) -> DataFrame:
    """Count child rows whose non-NULL foreign key has no parent (one anti join)."""
    p = parent.select(F.col(pk).alias("_pk"))
    bad = child.select(F.col(fk).alias("_fk")).where(F.col("_fk").isNotNull()) \
        .join(p, F.col("_fk") == F.col("_pk"), "left_anti")
    return bad.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
        F.lit(label[0]).alias("child_table"), F.lit(label[1]).alias("fk_column"),
        F.lit(label[2]).alias("parent_table"), F.lit(label[3]).alias("pk_column"), "orphan_rows")


def dup_keys(df: DataFrame, pk: Sequence[str], table: str) -> DataFrame:
    """Keys that identify more than one row: how many keys, how many rows."""
    d = df.groupBy(*pk).count().where(F.col("count") > 1)
    return d.agg(F.count(F.lit(1)).alias("duplicated_keys"),
                 F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("rows_with_duplicated_key")).select(
        F.lit(table).alias("table_name"), F.lit(",".join(pk)).alias("key_columns"), "duplicated_keys",
        "rows_with_duplicated_key")
