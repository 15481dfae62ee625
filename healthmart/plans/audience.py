"""C1-C3 from stored patient bitmaps.

``patient_bitmaps`` turns the outcomes once into exact sets: for each company and month, the persons as
bitmaps of 32,768 bits, one for each stretch of person ids.  Bitmaps merge by OR, so the distinct patients of
any company, group of companies, run of months or merger are counted from the stored table, without the
outcomes.  Persons are deduplicated before the bitmaps are built, and each bitmap is built where its persons
have been brought together, so no task holds bitmaps of stretches that it has only a few persons of.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a stored set: company (``known``: the indication's medicine exists), first day of the month,
#: stretch of person ids.
GRAIN = ["known", "company", "month", "stretch"]


def patient_bitmaps(outcome: DataFrame, medicine: DataFrame, indication: DataFrame) -> DataFrame:
    """``(known, company, month, stretch, persons)`` for outcomes that have a person and an indication."""
    company = indication.select("indication_id", "medicine_id").join(
        medicine.select(F.col("medicine_id").alias("_m"), "company"), F.col("medicine_id") == F.col("_m"), "left") \
        .select("indication_id", F.col("_m").isNotNull().alias("known"), "company")
    seen = outcome.where(F.col("person_id").isNotNull() & F.col("indication_id").isNotNull()).select(
        "person_id", "indication_id", F.trunc("outcome_date", "MM").alias("month"))
    seen = seen.join(company, "indication_id", "left").select(F.coalesce("known", F.lit(False)).alias("known"), "company", "month", "person_id").distinct()
    return seen.withColumn("stretch", F.bitmap_bucket_number("person_id")).repartition(*GRAIN) \
        .groupBy(*GRAIN).agg(F.bitmap_construct_agg(F.bitmap_bit_position("person_id")).alias("persons"))


def in_months(bitmaps: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """The sets of the months from ``first`` to ``last`` (None: all, also outcomes without a date)."""
    if first is not None:
        bitmaps = bitmaps.where(F.col("month") >= F.lit(first))
    return bitmaps if last is None else bitmaps.where(F.col("month") <= F.lit(last))


def after_merger(bitmaps: DataFrame, moved: Mapping[str, str]) -> DataFrame:
    """The sets with companies renamed to their acquirers."""
    name: Column = F.col("company")
    for acquired, acquirer in moved.items():
        name = F.when(F.col("company") == acquired, F.lit(acquirer)).otherwise(name)
    return bitmaps.withColumn("company", name)


def distinct_patients(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Distinct persons per ``by`` (none: one row): OR of the sets of each stretch, then a sum of their counts."""
    merged = bitmaps.groupBy(*by, "stretch").agg(F.bitmap_or_agg("persons").alias("persons"))
    count = F.coalesce(F.sum(F.bitmap_count("persons")), F.lit(0)).cast("bigint").alias("patients")
    return merged.groupBy(*by).agg(count) if by else merged.agg(count)


def audience(bitmaps: DataFrame, company: str) -> DataFrame:
    """C1, C2 and C3 as rows ``(kpi, company_name, patients)`` from stored sets."""
    own = F.col("known") & F.coalesce(F.col("company") == company, F.lit(False))
    nobody = F.lit(None).cast("string").alias("company_name")
    c1 = distinct_patients(bitmaps.where(own)).select(F.lit("c1").alias("kpi"), nobody, "patients")
    c2 = distinct_patients(bitmaps.where(~own)).select(F.lit("c2").alias("kpi"), nobody, "patients")
    c3 = distinct_patients(bitmaps.where("known"), "company").select(F.lit("c3").alias("kpi"), F.col("company").alias("company_name"), "patients")
    return c1.unionByName(c2).unionByName(c3)
