"""Warehouse dimensions M1-M11 (the star schema's dimension loads).

Key rule (T1): a dimension built from DISTINCT attribute tuples numbers its rows by the smallest
source id of each tuple, so the surrogate equals the source id whenever source rows are
distinct; age ids are bucket numbers, gender ids follow the code.  Facts never rely on that
coincidence: ``source_map`` joins source rows to dimension rows through the attributes.

Dimensions whose size grows with the data use the range-partitioned key builder (no single-partition
sort); those of a fixed domain (age buckets, gender codes, calendar years) state its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import age_bucket, age_range, gender_desc, year_of
from ..operators.joins import lookup
from ..operators.keys import (AGE_BUCKETS, GENDER_CODES, YEARS, fixed_domain, with_dense_id)

# Re-aimed default validity of the intensity SCD dimension (the reference uses 2020-2025 for
# outcomes dated 2020-2023; the test tables ship 1995-2001).
SCD_DEFAULT_START = 1995
SCD_DEFAULT_END = 2003


def dim_from_distinct(df: DataFrame, attrs: Sequence[str], src_id: str, id_name: str,
                      renames: dict[str, str] | None = None, at_most: int | None = None) -> DataFrame:
    """DISTINCT attrs, numbered by the smallest source id of each tuple.  ``at_most`` when
    the source is a fixed domain of that size."""
    renames = renames or {}
    g = df.groupBy(*attrs).agg(F.min(src_id).alias("_src"))
    g = with_dense_id(g, ["_src"], id_name, at_most=at_most)
    return g.select(id_name, *[F.col(a).alias(renames.get(a, a)) for a in attrs])


def source_map(df: DataFrame, dim: DataFrame, attrs: Sequence[str], src_id: str, id_name: str,
               renames: dict[str, str] | None = None) -> DataFrame:
    """(src_id, dim_id): source id -> dimension id through the attribute tuple (NULL-safe)."""
    renames = renames or {}
    s = df.select(F.col(src_id).alias("_sid"), *[F.col(a).alias(f"_a_{a}") for a in attrs])
    cond = None
    for a in attrs:
        c = s[f"_a_{a}"].eqNullSafe(dim[renames.get(a, a)])
        cond = c if cond is None else cond & c
    return s.join(dim, cond, "inner").select(F.col("_sid").alias("src_id"), dim[id_name].alias("dim_id"))


def dim_age(person: DataFrame) -> DataFrame:
    """M1: the age buckets present in the data; age_id is the bucket number (1-8)."""
    return fixed_domain(person.select(age_bucket(F.col("age")).alias("age_id"),
                                      age_range(F.col("age")).alias("age_range")).distinct(), AGE_BUCKETS).drop("_nth")


DISEASE_ATTRS = ["disease_name", "intensity_level_qty", "disease_type_code"]


def dim_disease(disease: DataFrame, at_most: int | None = None) -> DataFrame:
    """M2."""
    return dim_from_distinct(disease, DISEASE_ATTRS, "disease_id", "disease_id", at_most=at_most)


def dim_medicine(medicine: DataFrame) -> DataFrame:
    """M3: distinct (name, company); merged drugs collapse into one row."""
    return dim_from_distinct(medicine, ["name", "company"], "medicine_id", "medicine_id",
                             {"name": "medicine_name"})


def dim_indication(indication: DataFrame, medicine: DataFrame, dim_med: DataFrame, *,
                   literal: bool = False) -> DataFrame:
    """M4: indications with their medicine expressed as a dim_medicine id.

    Default: the medicine is mapped through (name, company), so nothing is lost when the merger
    collapses drugs (T2).  ``literal=True`` reproduces the reference exactly: keep indications
    whose *source* medicine id happens to equal some dim_medicine id, ids unchanged.
    """
    ind = indication.select("indication_id", "medicine_id", "disease_id")
    if literal:
        keep = dim_med.select(F.col("medicine_id").alias("_m"))
        return ind.join(keep, ind.medicine_id == keep._m, "left_semi").distinct()
    # source medicine id -> dim id through (name, company); an unknown medicine drops the indication.
    pairs = source_map(medicine, dim_med, ["name", "company"], "medicine_id", "medicine_id",
                       {"name": "medicine_name"})
    out = ind.join(pairs, ind.medicine_id == pairs.src_id, "inner")
    return out.select("indication_id", F.col("dim_id").alias("medicine_id"), "disease_id").distinct()


def dim_gender(person: DataFrame) -> DataFrame:
    """M5: distinct gender codes with their description, numbered by code (bounded domain)."""
    g = person.select(F.col("gender")).where(F.col("gender").isNotNull()).distinct() \
        .select("gender", gender_desc(F.col("gender")).alias("gender_desc"))
    return with_dense_id(g, ["gender"], "gender_id", at_most=GENDER_CODES).select("gender_id", "gender", "gender_desc")


LOCATION_ATTRS = ["city_name", "state_province_name", "country_name", "developing_flag", "wealth_rank_number"]


def dim_location(location: DataFrame, at_most: int | None = None) -> DataFrame:
    """M6."""
    return dim_from_distinct(location, LOCATION_ATTRS, "location_id", "location_id", at_most=at_most)


PROFIT_ATTRS = ["cost", "price", "profit", "percentage_profit"]


def dim_profit(profit: DataFrame) -> DataFrame:
    """M7: distinct amount tuples; the indication id is not kept (nothing references it)."""
    return dim_from_distinct(profit, PROFIT_ATTRS, "profit_id", "profit_id")


def dim_year(outcome: DataFrame) -> DataFrame:
    """M8: outcome years, numbered in order (bounded by the calendar).  Reads the outcome date only, so
    outcome rows without their person (no join) will do."""
    years = outcome.select(year_of(F.col("outcome_date")).alias("year")).distinct()
    return with_dense_id(years, ["year"], "year_id", at_most=YEARS).select("year_id", "year")


def dim_diseased_patient(person: DataFrame, d_gender: DataFrame, d_age: DataFrame) -> DataFrame:
    """M9: one row per patient, gender and age as dimension ids (scalar lookups: no match ->
    NULL, two matches -> error).  ``person_id`` is kept as lineage (T3)."""
    p = person.select("person_id", "last_name", "first_name", "gender", age_range(F.col("age")).alias("_ar"),
                      "is_insured", "start_date", "end_date")
    p = lookup(p, d_gender, {"gender": "gender"}, ["gender_id"])
    p = lookup(p, d_age, {"_ar": "age_range"}, ["age_id"])
    p = with_dense_id(p, ["person_id"], "diseased_patient_id")
    return p.select("diseased_patient_id", "last_name", "first_name", "gender_id", "age_id", "is_insured",
                    "start_date", "end_date", "person_id")


def dim_intensity_level(disease: DataFrame, at_most: int | None = None) -> DataFrame:
    """Distinct non-NULL intensity levels, numbered in order."""
    lv = disease.where(F.col("intensity_level_qty").isNotNull()) \
        .select(F.col("intensity_level_qty").alias("intensity_level")).distinct()
    return with_dense_id(lv, ["intensity_level"], "intensity_level_id", at_most=at_most) \
        .select("intensity_level_id", "intensity_level")


def dim_disease_intensity(disease: DataFrame, d_disease: DataFrame, d_level: DataFrame,
                          start_year: int = SCD_DEFAULT_START, end_year: int | None = SCD_DEFAULT_END,
                          at_most: int | None = None) -> DataFrame:
    """Initial load of the SCD-2 intensity dimension - every disease current, with the
    default validity; ids follow the source disease id."""
    j = disease.select("disease_id", "disease_name", "intensity_level_qty") \
        .join(d_disease.select(F.col("disease_name").alias("_dn")), F.col("disease_name") == F.col("_dn"), "inner") \
        .join(d_level, F.col("intensity_level_qty") == d_level.intensity_level, "inner")
    j = j.select("disease_id", "disease_name", "intensity_level",
                 F.lit(start_year).cast("long").alias("start_year"),
                 F.lit(end_year).cast("long").alias("end_year"), F.lit(True).alias("is_current"))
    j = with_dense_id(j, ["disease_id", "disease_name", "intensity_level"], "intensity_level_scd_id", at_most=at_most)
    return j.select("intensity_level_scd_id", "disease_name", "intensity_level", "start_year", "end_year",
                    "is_current")
