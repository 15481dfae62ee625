"""Join-shaped operators: semi/anti joins for IN / NOT IN / EXISTS, scalar lookups, the
pre-aggregated frequency join and the validity range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """A relational assumption (unique key, non-NULL key) does not hold for the data."""


def _pairs(on: str | Sequence[str] | dict[str, str]) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(c, c) for c in on]


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Q5/Q6/Q12: rows of ``df`` whose key occurs in ``keys`` (IN / EXISTS).  Never duplicates."""
    pairs = _pairs(on)
    k = keys.select(*[F.col(rc).alias(f"_k{i}") for i, (_, rc) in enumerate(pairs)])
    cond = None
    for i, (lc, _) in enumerate(pairs):
        c = df[lc] == k[f"_k{i}"]
        cond = c if cond is None else cond & c
    return df.join(k, cond, "left_semi")


def not_in(df: DataFrame, keys: DataFrame, on: str | dict[str, str], *, check: bool = True) -> DataFrame:
    """Q7: ``df.col NOT IN (SELECT key FROM keys)`` with SQL's NULL rules, as a plain anti join.

    SQL returns no row at all when the subquery yields a NULL; we refuse that case instead of
    returning a silently empty answer (T4).  Rows whose own key is NULL are dropped unless
    ``keys`` is empty, in which case NOT IN keeps every row.  With the right keys proven
    non-NULL the anti join can shuffle (no null-aware single-partition broadcast needed).
    """
    (lc, rc), = _pairs(on)
    right = keys.select(F.col(rc).alias("_nk"))
    if check:
        # One job answers both questions (the key set is aggregated, never collected).
        total, nulls = right.agg(F.count(F.lit(1)), F.count_if(F.col("_nk").isNull())).first()
        if nulls:
            raise IntegrityError(f"NOT IN subquery over {rc!r} contains NULL: the SQL answer would be empty")
        if total == 0:
            return df
    return df.where(F.col(lc).isNotNull()).join(right, df[lc] == right["_nk"], "left_anti")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """Fail fast when a key that must identify one row identifies several (T6, Q9); returns ``df``."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise IntegrityError(f"{what}: key {dict(zip(keys, dup[0][:len(keys)]))} matches more than one row")
    return df


def lookup(df: DataFrame, dim: DataFrame, on, cols: Sequence[str], *, check: bool = True) -> DataFrame:
    """Q9/Q10: correlated scalar subquery ``(SELECT col FROM dim WHERE dim.k = df.k)`` as a left join.

    No match gives NULL; more than one match raises, as the scalar subquery would.
    """
    pairs = _pairs(on)
    if check:
        dim = assert_unique(dim, [rc for _, rc in pairs], "scalar lookup")
    r = dim.select(*[F.col(rc).alias(f"_l{i}") for i, (_, rc) in enumerate(pairs)], *cols)
    cond = None
    for i, (lc, _) in enumerate(pairs):
        c = df[lc] == r[f"_l{i}"]
        cond = c if cond is None else cond & c
    out = df.join(r, cond, "left")
    return out.drop(*[f"_l{i}" for i in range(len(pairs))])


def freq(df: DataFrame, keys: Sequence[str], name: str = "occurrence_count") -> DataFrame:
    """COUNT(*) per key - the hand-made eager aggregation of the reference.  Partial
    aggregation combines map-side, so a hot key costs one row per map task in the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def valid_in(years: DataFrame, versions: DataFrame, year_col: str = "year",
             start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """Pair each year with the versions whose [start, COALESCE(end, year)] holds it.

    Written as an equi-join: each version is expanded to the years it covers (an open end
    stops at the last year present), so no nested-loop join is planned.
    """
    first, last = years.agg(F.min(year_col), F.max(year_col)).first()  # two scalars to the driver
    if last is None:
        return years.join(versions, F.lit(False), "inner")
    # Clip each validity range to the years present, so the expansion is bounded by the year
    # dimension whatever the stored bounds are; an open end runs to the last year.
    lo = F.greatest(F.col(start_col).cast("long"), F.lit(int(first)))
    hi = F.least(F.coalesce(F.col(end_col).cast("long"), F.lit(int(last))), F.lit(int(last)))
    years_covered = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    v = versions.withColumn("_y", F.explode(years_covered))
    return years.join(v, years[year_col] == v["_y"], "inner").drop("_y")
