"""A1: declared schemas of the operational and warehouse tables.

Nothing is inferred.  Auto-numbered keys are plain integers assigned by
``operators.keys.with_dense_id``; CHAR(n) columns are strings trimmed at ingest;
VARCHAR(n) limits are checked as data by ``operators.integrity.apply_rules``.
Integer columns are 64-bit so that keys from any source fit without casts.
"""

from __future__ import annotations

from pyspark.sql import types as T

L = T.LongType()
S = T.StringType()
D = T.DateType()
B = T.BooleanType()
MONEY = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, T.StructType] = {
    "disease_type": _struct(("disease_type_code", S, False), ("disease_type_description", S, True),
                            ("exclusions_other_note_text", S, True)),
    "disease": _struct(("disease_id", L, False), ("disease_name", S, True),
                       ("intensity_level_qty", L, True), ("disease_type_code", S, True)),
    "medicine": _struct(("medicine_id", L, False), ("standard_industry_number", S, True),
                        ("name", S, True), ("company", S, True), ("active_ingredient_name", S, True)),
    "location": _struct(("location_id", L, False), ("city_name", S, True),
                        ("state_province_name", S, True), ("country_name", S, True),
                        ("developing_flag", S, True), ("wealth_rank_number", L, True)),
    "indication": _struct(("indication_id", L, False), ("medicine_id", L, True),
                          ("disease_id", L, True), ("dosage", S, True)),
    "diseased_patient": _struct(("person_id", L, False), ("last_name", S, True), ("first_name", S, True),
                                ("gender", S, True), ("primary_location_id", L, True), ("age", L, True),
                                ("disease_id", L, True), ("severity_value", L, True),
                                ("start_date", D, True), ("end_date", D, True), ("is_insured", B, True)),
    "profit": _struct(("profit_id", L, False), ("indication_id", L, True), ("cost", MONEY, True),
                      ("price", MONEY, True), ("profit", MONEY, True), ("percentage_profit", MONEY, True)),
    "outcome": _struct(("outcome_id", L, False), ("person_id", L, True), ("indication_id", L, True),
                       ("outcome", S, True), ("outcome_date", D, True), ("medicine_id", L, True)),
}

# Column defaults of the operational tables (A2/A8): applied to absent or NULL input.
DEFAULTS: dict[str, dict[str, object]] = {
    "disease": {"intensity_level_qty": 1},
    "diseased_patient": {"severity_value": 1, "is_insured": False},
}

# VARCHAR / CHAR length limits (A8).  CHAR columns are trimmed before the check.
VARCHAR_LIMITS: dict[str, dict[str, int]] = {
    "disease_type": {"disease_type_code": 5, "disease_type_description": 1000,
                     "exclusions_other_note_text": 2000},
    "disease": {"disease_name": 100, "disease_type_code": 10},
    "medicine": {"standard_industry_number": 25, "name": 250, "company": 150,
                 "active_ingredient_name": 150},
    "location": {"city_name": 100, "state_province_name": 100, "country_name": 100,
                 "developing_flag": 1},
    "indication": {"dosage": 50},
    "diseased_patient": {"last_name": 50, "first_name": 50, "gender": 1},
    "outcome": {"outcome": 30},
    "dim_gender": {"gender": 1, "gender_desc": 10},
    "dim_age": {"age_range": 20},
}

CHAR_COLUMNS: dict[str, list[str]] = {
    "disease_type": ["disease_type_code"],
    "disease": ["disease_type_code"],
    "location": ["developing_flag"],
    "diseased_patient": ["gender"],
}

# Declared foreign keys (child table, column, parent table, column) for the A9 report.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("disease", "disease_type_code", "disease_type", "disease_type_code"),
    ("indication", "disease_id", "disease", "disease_id"),
    ("indication", "medicine_id", "medicine", "medicine_id"),
    ("diseased_patient", "disease_id", "disease", "disease_id"),
    ("diseased_patient", "primary_location_id", "location", "location_id"),
    ("profit", "indication_id", "indication", "indication_id"),
    ("outcome", "person_id", "diseased_patient", "person_id"),
    ("outcome", "indication_id", "indication", "indication_id"),
]

PRIMARY_KEYS: dict[str, list[str]] = {
    "disease_type": ["disease_type_code"], "disease": ["disease_id"], "medicine": ["medicine_id"],
    "location": ["location_id"], "indication": ["indication_id"],
    "diseased_patient": ["person_id"], "profit": ["profit_id"], "outcome": ["outcome_id"],
}

WAREHOUSE_SCHEMAS: dict[str, T.StructType] = {
    "dim_age": _struct(("age_id", L, False), ("age_range", S, True)),
    "dim_disease": _struct(("disease_id", L, False), ("disease_name", S, True),
                           ("intensity_level_qty", L, True), ("disease_type_code", S, True)),
    "dim_medicine": _struct(("medicine_id", L, False), ("medicine_name", S, True), ("company", S, True)),
    "dim_indication": _struct(("indication_id", L, False), ("medicine_id", L, True), ("disease_id", L, True)),
    "dim_gender": _struct(("gender_id", L, False), ("gender", S, False), ("gender_desc", S, False)),
    "dim_location": _struct(("location_id", L, False), ("city_name", S, True),
                            ("state_province_name", S, True), ("country_name", S, True),
                            ("developing_flag", S, True), ("wealth_rank_number", L, True)),
    "dim_profit": _struct(("profit_id", L, False), ("cost", MONEY, True), ("price", MONEY, True),
                          ("profit", MONEY, True), ("percentage_profit", MONEY, True)),
    "dim_year": _struct(("year_id", L, False), ("year", L, True)),
    "dim_diseased_patient": _struct(("diseased_patient_id", L, False), ("last_name", S, True),
                                    ("first_name", S, True), ("gender_id", L, True), ("age_id", L, True),
                                    ("is_insured", B, True), ("start_date", D, True), ("end_date", D, True),
                                    ("person_id", L, True)),
    "dim_intensity_level_quantity": _struct(("intensity_level_id", L, False), ("intensity_level", L, True)),
    "dim_disease_intensity_level": _struct(("intensity_level_scd_id", L, False), ("disease_name", S, True),
                                           ("intensity_level", L, True), ("start_year", L, False),
                                           ("end_year", L, True), ("is_current", B, True)),
    "fact_disease_intensity": _struct(("fact_disease_intensity_id", L, False), ("year_id", L, True),
                                      ("disease_id", L, True), ("intensity_level_id", L, True)),
}
