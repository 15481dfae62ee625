"""Table-changing jobs as pure functions: old DataFrame -> new DataFrame.

Plain Parquet tables have no UPDATE or MERGE, so each job returns the whole new table; the
caller writes it to a new version and swaps (see ``sources.tables.Catalog.replace``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import IntegrityError, _pairs, assert_unique
from .keys import with_dense_id
from .scd import scd2_merge


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def update_where(df: DataFrame, cond: Column, assignments: Mapping[str, object]) -> DataFrame:
    """UPDATE t SET col = value WHERE cond.  Every value reads the old row; a NULL
    condition leaves the row unchanged."""
    hit = F.coalesce(cond, F.lit(False))
    return df.select(*[
        F.when(hit, _lit(assignments[c]).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in assignments else F.col(c) for c in df.columns])


def update_from(df: DataFrame, src: DataFrame, on, assignments: Mapping[str, str],
                cond: Column | None = None, *, check: bool = True) -> DataFrame:
    """UPDATE t SET col = s.src_col FROM s WHERE t.k = s.k [AND cond].

    Each target row may match at most one source row (checked, T6); PostgreSQL would pick one
    arbitrarily.  A matched NULL source value overwrites, so the match is carried as a flag.
    ``cond`` may only reference target columns.
    """
    pairs = _pairs(on)
    if check:
        src = assert_unique(src, [rc for _, rc in pairs], "UPDATE ... FROM source")
    s = src.select(*[F.col(rc).alias(f"_u{i}") for i, (_, rc) in enumerate(pairs)],
                   *[F.col(v).alias(f"_v_{k}") for k, v in assignments.items()],
                   F.lit(True).alias("_matched"))
    on_cond = None
    for i, (lc, _) in enumerate(pairs):
        c = df[lc] == s[f"_u{i}"]
        on_cond = c if on_cond is None else on_cond & c
    j = df.join(s, on_cond, "left")
    hit = F.col("_matched").isNotNull()
    if cond is not None:
        hit = hit & F.coalesce(cond, F.lit(False))
    return j.select(*[
        F.when(hit, F.col(f"_v_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c in assignments else F.col(c) for c in df.columns])


def remap_key(child: DataFrame, fk: str, mapping: DataFrame, old: str = "old_key",
              new: str = "new_key", *, check: bool = True) -> DataFrame:
    """ON UPDATE CASCADE - rewrite a child's foreign key through an old -> new key map."""
    if check:
        mapping = assert_unique(mapping, [old], "key remapping")
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"), F.lit(True).alias("_hit"))
    j = child.join(m, child[fk] == m["_old"], "left")
    return j.select(*[F.when(F.col("_hit").isNotNull(), F.col("_new").cast(child.schema[fk].dataType))
                      .otherwise(F.col(fk)).alias(fk) if c == fk else F.col(c) for c in child.columns])


# -- slowly changing dimension (type 2) ------------------------------------------------------

def scd2_close(dim: DataFrame, keys: DataFrame, key: str, end_year: int,
               current_col: str = "is_current", end_col: str = "end_year") -> DataFrame:
    """D3: for current versions whose ``key`` occurs in ``keys``: set the end and clear current.
    The join to ``keys`` is an existence test only (left semi)."""
    k = keys.select(F.col(key).alias("_ck")).distinct().withColumn("_close", F.lit(True))
    j = dim.join(k, dim[key] == k["_ck"], "left")
    hit = F.col("_close").isNotNull() & F.coalesce(F.col(current_col), F.lit(False))
    return j.select(*[
        F.when(hit, F.lit(end_year).cast(dim.schema[end_col].dataType)).otherwise(F.col(end_col)).alias(end_col)
        if c == end_col else
        F.when(hit, F.lit(False)).otherwise(F.col(current_col)).alias(current_col)
        if c == current_col else F.col(c) for c in dim.columns])


def scd2_open(dim: DataFrame, rows: DataFrame, id_col: str, defaults: Mapping[str, object]) -> DataFrame:
    """Append new versions, numbering them after the largest existing id; columns absent
    from ``rows`` take ``defaults``.  A change batch may be of any size."""
    add = rows
    for c, v in defaults.items():
        if c not in add.columns:
            add = add.withColumn(c, F.lit(v))
        else:
            add = add.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    add = add.select(*[F.col(c).cast(dim.schema[c].dataType) for c in dim.columns if c != id_col])
    top = dim.agg(F.max(id_col)).first()[0] or 0
    add = with_dense_id(add, [c for c in add.columns], id_col, start=int(top) + 1)
    return dim.unionByName(add.select(*dim.columns))


def scd2_apply(dim: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str], start_year: int,
               id_col: str, end_year: int | None = None, current_col: str = "is_current",
               start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """D4b for a batch that starts in one year: close the current version of every changed key (end =
    start_year - 1) and open the new version [start_year, end_year]; unchanged keys and new
    keys are handled alike.  A key listed twice in the batch is an error."""
    batch = changes.select(key, *attrs, F.lit(start_year).cast("bigint").alias(start_col), F.lit(end_year).cast("bigint").alias(end_col))
    return scd2_merge(dim, batch, key, attrs, id_col, current_col, start_col, end_col)


def restate(fact: DataFrame, versions_by_year: DataFrame, fact_keys: Sequence[str], target: str,
            value_col: str) -> DataFrame:
    """Set ``fact[target]`` from the current version covering each fact row's keys.

    ``versions_by_year`` holds one row per (keys) of a *current* version, with ``value_col`` the
    new value (NULL when the version's value has no dimension row).  Fact rows with no
    covering version keep their value; two covering versions are an error (the reference's
    scalar subquery would fail).  Running it twice gives the same table.
    """
    versions_by_year = assert_unique(versions_by_year, list(fact_keys), "restatement source")
    v = versions_by_year.select(*[F.col(k).alias(f"_r_{k}") for k in fact_keys],
                                F.col(value_col).alias("_r_val"), F.lit(True).alias("_r_hit"))
    cond = None
    for k in fact_keys:
        c = fact[k] == v[f"_r_{k}"]
        cond = c if cond is None else cond & c
    j = fact.join(v, cond, "left")
    return j.select(*[F.when(F.col("_r_hit").isNotNull(), F.col("_r_val").cast(fact.schema[target].dataType))
                      .otherwise(F.col(target)).alias(target) if c == target else F.col(c)
                      for c in fact.columns])


__all__ = ["IntegrityError", "update_where", "update_from", "remap_key", "scd2_close", "scd2_open",
           "scd2_apply", "restate"]
