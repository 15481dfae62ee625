"""A8 and A9 on load: an append that splits its batch by the declared constraints.

Every row of the batch is either accepted or rejected with all its reasons: a text longer than its column, a
NULL in a NOT NULL column, a key that the batch or the table has already, a foreign key without a parent.
Defaults and CHAR trimming apply first (``sources.tables.conform``).  Rows that share a key inside the batch
are all rejected, as none has a better claim.

A parent is first reduced to the keys that occur in the batch, by a semi join, before the batch meets it.
Spark broadcasts the batch's keys when they measure small, and puts its own Bloom filter on the scan of a
large parent when they do not; the check itself is the exact join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import CHAR_COLUMNS, DEFAULTS, FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, VARCHAR_LIMITS
from ..sources.tables import Catalog, conform
from .keys import freeze


def column_reasons(df: DataFrame, not_null: Sequence[str], limits: Mapping[str, int]) -> list[Column]:
    """For each rule its reason where the row breaks it, else NULL."""
    out = [F.when(F.col(c).isNull(), F.lit(f"{c}: not null")) for c in not_null]
    return out + [F.when(F.length(F.col(c)) > n, F.lit(f"{c}: longer than {n}")) for c, n in limits.items()]


def _marked(batch: DataFrame, cols: Sequence[str], other: DataFrame, other_cols: Sequence[str], flag: str) -> DataFrame:
    """``batch`` with ``flag``: whether ``cols`` occur among ``other_cols`` of ``other``."""
    asked = batch.select(*[F.col(c).alias(f"_a{i}") for i, c in enumerate(cols)]).dropna().distinct()
    here = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(other_cols)])
    on = [F.col(f"_k{i}") == F.col(f"_a{i}") for i in range(len(cols))]
    present = here.join(asked, on, "left_semi").distinct().withColumn(flag, F.lit(True))
    joined = batch.join(present, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(cols)], "left")
    return joined.drop(*[f"_k{i}" for i in range(len(cols))])


def split_batch(batch: DataFrame, table: str, existing: DataFrame | None, parents: Mapping[str, DataFrame],
                limits: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a batch for an operational table; rejected ones carry their ``reasons``.  A
    foreign key whose parent table is not among ``parents`` is not checked."""
    schema, key = SCHEMAS[table], PRIMARY_KEYS[table]
    rows = freeze(conform(batch, schema, DEFAULTS.get(table), CHAR_COLUMNS.get(table, ())), "batch")   # read by every check
    reasons = column_reasons(rows, [f.name for f in schema.fields if not f.nullable], VARCHAR_LIMITS.get(table, {}) if limits is None else limits)
    twice = rows.groupBy(*key).count().where(F.col("count") > 1)
    marked = _marked(rows, key, twice, key, "_twice")
    reasons.append(F.when(F.col("_twice"), F.lit(f"{','.join(key)}: twice in the batch")))
    if existing is not None:
        marked = _marked(marked, key, existing, key, "_stored")
        reasons.append(F.when(F.col("_stored"), F.lit(f"{','.join(key)}: already stored")))
    for child, fk, parent, pk in FOREIGN_KEYS:
        if child == table and parent in parents:
            marked = _marked(marked, [fk], parents[parent], [pk], f"_ok_{fk}")
            reasons.append(F.when(F.col(fk).isNotNull() & F.col(f"_ok_{fk}").isNull(), F.lit(f"{fk}: no such {parent}")))
    judged = marked.select(*schema.names, F.array_sort(F.filter(F.array(*reasons), lambda r: r.isNotNull())).alias("reasons"))
    judged = freeze(judged, "judged")
    return judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0)


def checked_append(cat: Catalog, table: str, batch: DataFrame, limits: Mapping[str, int] | None = None) -> tuple[int, int]:
    """Append the accepted rows of a batch to a stored table and the others, with their reasons, to
    ``<table>__rejected``.  Returns how many were accepted and rejected; they add up to the batch."""
    parents = {p for c, _, p, _ in FOREIGN_KEYS if c == table and cat.exists(p)}
    good, bad = split_batch(batch, table, cat.scan(table) if cat.exists(table) else None, {p: cat.scan(p) for p in parents}, limits)
    for name, df in ((table, good), (f"{table}__rejected", bad)):
        df.write.mode("append").format("parquet").saveAsTable(cat.name(name))
    return good.count(), bad.count()
