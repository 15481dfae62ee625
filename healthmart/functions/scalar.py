"""Scalar column functions (X1-X8) and exact money arithmetic.

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: age bucket upper bounds (inclusive)
# and the labels of the eight buckets, in order.
AGE_UPPER_BOUNDS = [10, 20, 30, 40, 50, 60, 70]
AGE_LABELS = ["0-10", "11-20", "21-30", "31-40", "41-50", "51-60", "61-70", "71+"]

# Gender codes and their descriptions; anything else is 'Unknown'.
GENDER_DESCRIPTIONS = {"M": "Male", "F": "Female"}
UNKNOWN_GENDER = "Unknown"


def _buckets(age: Column, values: list) -> Column:
    """First bound that the age does not exceed; NULL and ages above the last bound take the
    last value (the ELSE branch), negative ages the first."""
    expr = None
    for bound, value in zip(AGE_UPPER_BOUNDS, values):
        expr = F.when(age <= bound, F.lit(value)) if expr is None else expr.when(age <= bound, F.lit(value))
    return expr.otherwise(F.lit(values[len(AGE_UPPER_BOUNDS)]))


def age_range(age: Column) -> Column:
    """Age -> bucket label."""
    return _buckets(age, AGE_LABELS)


def age_bucket(age: Column) -> Column:
    """Age -> bucket number 1..8, consistent with ``age_range``."""
    return _buckets(age, list(range(1, len(AGE_LABELS) + 1))).cast("long")


def gender_desc(gender: Column) -> Column:
    """Gender code -> description."""
    expr = None
    for code, desc in GENDER_DESCRIPTIONS.items():
        expr = F.when(gender == code, desc) if expr is None else expr.when(gender == code, desc)
    return expr.otherwise(UNKNOWN_GENDER)


def outcome_is(outcome: Column, value: str) -> Column:
    """Outcome flag as 0/1.  ``recovered AND != relapse`` reduces to ``= recovered``;
    a NULL outcome counts as 0."""
    return F.when(outcome == value, F.lit(1)).otherwise(F.lit(0)).cast("long")


def year_of(date: Column) -> Column:
    """EXTRACT(YEAR FROM date) as a 64-bit integer."""
    return F.year(date).cast("long")


def to_int_strict(text: Column) -> Column:
    """Text -> integer; raises on malformed input (ANSI cast), never yields a silent NULL."""
    return F.trim(text).cast("long")


WIDE = "decimal(38,0)"


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) to an integer, halves away from zero; NULL when den is 0 or NULL.

    Exact integer arithmetic in 38 digits, so neither a double's rounding nor a 64-bit overflow can
    change the result; the quotient itself must fit 64 bits.
    """
    n, d = num.cast(WIDE), den.cast(WIDE)
    q = F.call_function("div", (F.abs(n) * 2 + d).cast(WIDE), F.when(d > 0, (d * 2).cast(WIDE)))
    return F.when(d > 0, F.signum(n).cast("long") * q.cast("long"))


def hundredths_to_money(hundredths: Column) -> Column:
    """Integer hundredths -> DECIMAL(10,2), exactly."""
    return (hundredths.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def ratio_money(num: Column, den: Column, scale: int = 1) -> Column:
    """DECIMAL(10,2) of ``scale * num / den`` rounded half away from zero, as PostgreSQL stores a
    numeric quotient into DECIMAL(10,2).  ``num`` is in hundredths when it is money."""
    return hundredths_to_money(half_up_div(num.cast(WIDE) * scale, den))


def money_from_double(value: Column) -> tuple[Column, Column]:
    """A double amount -> (integer cents, DECIMAL(10,2)).  Rounding to cents is unambiguous for
    amounts that carry at most two decimals."""
    cents = F.round(value * 100).cast("long")
    return cents, hundredths_to_money(cents)
