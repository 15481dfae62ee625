"""Aggregate building blocks (G6-G11).  All are partial-aggregation friendly sums and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import ratio_money


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END); a NULL condition counts 0, empty input gives NULL."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long"))


def weighted_sum(weight: Column, value: Column) -> Column:
    """SUM(weight * value); NULL on empty input, not 0."""
    return F.sum(weight * value)


def pct_of_rows(hits: Column, rows: Column) -> Column:
    """Hits * 100.0 / rows as DECIMAL(10,2); the denominator is every row of the group."""
    return ratio_money(hits, rows, scale=10000)


def weighted_mean(weighted_cents: Column, weights: Column) -> Column:
    """SUM(w*x) / SUM(w) with x in cents, DECIMAL(10,2); 0 when the weights sum to 0."""
    return F.when(weights > 0, ratio_money(weighted_cents, weights)).otherwise(
        F.lit(0).cast("decimal(10,2)"))
