"""Governed reads (R1-R7): the doctor's flattened record, per-patient row filters and the
patient's own record.

Row filters are plain predicates on a literal person id, so they reach the Parquet scans as
pushed filters.  They shape what a role sees through this API; enforcement against direct
file access belongs to the catalog that owns the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import semi

RECORD_COLS = ["person_id", "last_name", "first_name", "gender", "age", "country_name", "is_insured",
               "disease", "medication_name", "severity_value", "start_date", "end_date"]


class ContextNotSet(RuntimeError):
    """A patient read was attempted without a person context (never 'all rows')."""


def patient_record(person: DataFrame, disease: DataFrame, location: DataFrame) -> DataFrame:
    """The patient half of R1: patient attributes with condition name and country."""
    return person.join(disease.select("disease_id", F.col("disease_name").alias("disease")), "disease_id", "inner") \
        .join(location.select(F.col("location_id").alias("primary_location_id"), "country_name"),
              "primary_location_id", "inner")


def drug_names(indication: DataFrame, medicine: DataFrame) -> DataFrame:
    """The drug half of R1: indication -> medicine name."""
    return indication.select("indication_id", "medicine_id") \
        .join(medicine.select("medicine_id", F.col("name").alias("medication_name")), "medicine_id", "inner")


def medical_records(outcome: DataFrame, person: DataFrame, disease: DataFrame, indication: DataFrame,
                    medicine: DataFrame, location: DataFrame) -> DataFrame:
    """One row per outcome with its patient, condition, drug and country (inner joins, so
    incomplete rows drop).  Small tables meet their partner before the outcome side does."""
    j = outcome.select("person_id", "indication_id").join(patient_record(person, disease, location),
                                                          "person_id", "inner")
    return medical_records_from(j, indication, medicine)


def medical_records_from(outcome_with_patient: DataFrame, indication: DataFrame, medicine: DataFrame) -> DataFrame:
    """R1 for outcome rows that already carry their patient's record columns."""
    return outcome_with_patient.join(drug_names(indication, medicine), "indication_id", "inner").select(*RECORD_COLS)


def own_rows(df: DataFrame, person_id: int | None, col: str = "person_id") -> DataFrame:
    """Rows of one person."""
    if person_id is None:
        raise ContextNotSet("no person context set")
    return df.where(F.col(col) == F.lit(int(person_id)))


def own_via(indication: DataFrame, outcome: DataFrame, person_id: int | None) -> DataFrame:
    """Indications that appear in the person's own outcomes (EXISTS -> semi join)."""
    return semi(indication, own_rows(outcome, person_id).select("indication_id"), "indication_id")


@dataclass
class PatientSession:
    """The person context; every table it hands out is already filtered."""

    person_id: int | None

    def patient(self, person: DataFrame) -> DataFrame:
        return own_rows(person, self.person_id)

    def outcome(self, outcome: DataFrame) -> DataFrame:
        return own_rows(outcome, self.person_id)

    def indication(self, indication: DataFrame, outcome: DataFrame) -> DataFrame:
        return own_via(indication, outcome, self.person_id)


def my_record(ctx: PatientSession, person: DataFrame, location: DataFrame, disease: DataFrame,
              outcome: DataFrame, indication: DataFrame, medicine: DataFrame) -> DataFrame:
    """The patient's own record - left joins over the filtered tables, so a patient without
    outcomes still gets one row (with NULL person_id, which is read from the outcome side)."""
    dp = ctx.patient(person)
    o = ctx.outcome(outcome).select(F.col("person_id").alias("o_person_id"), "indication_id")
    i = ctx.indication(indication, outcome).select("indication_id", "medicine_id")
    j = dp.join(location.select(F.col("location_id").alias("_loc"), "country_name"),
                dp.primary_location_id == F.col("_loc"), "left") \
        .join(disease.select(F.col("disease_id").alias("_dis"), F.col("disease_name").alias("disease")),
              dp.disease_id == F.col("_dis"), "left") \
        .join(o, dp.person_id == o.o_person_id, "left") \
        .join(i, "indication_id", "left") \
        .join(medicine.select(F.col("medicine_id").alias("_med"), F.col("name").alias("medication_name")),
              F.col("medicine_id") == F.col("_med"), "left")
    j = j.where(dp.person_id == F.lit(int(ctx.person_id)))
    return j.select(F.col("o_person_id").alias("person_id"), *RECORD_COLS[1:])


DOCTOR_VIEW = "medical_records_doctor"
PATIENT_TABLES = ("diseased_patient", "location", "disease", "medicine", "outcome", "indication")


def role_session(spark: SparkSession, tables: "callable", role: str, person_id: int | None = None) -> SparkSession:
    """A new Spark session whose temp views are exactly what ``role`` may read.

    ``tables(session)`` returns the operational tables as DataFrames of that session.  The doctor
    sees only the flattened record view; a patient sees six tables, three of them filtered to the
    person (profit and disease_type are absent).  No view holds rows of anybody else.  The person id
    is also a session variable (X9); ``set_patient`` changes both.  Without a person every read of a
    filtered view fails instead of returning everything.
    """
    s = spark.newSession()
    t = tables(s)
    if role == "doctor":
        medical_records(t["outcome"], t["diseased_patient"], t["disease"], t["indication"], t["medicine"],
                        t["location"]).createOrReplaceTempView(DOCTOR_VIEW)
        return s
    if role != "patient":
        raise ValueError(f"unknown role {role!r}")
    set_patient(s, t, person_id)
    return s


def set_patient(session: SparkSession, tables: "dict[str, DataFrame]", person_id: int | None) -> None:
    """Make ``person_id`` the session's patient (None: nobody)."""
    session.sql("DECLARE OR REPLACE VARIABLE current_person_id BIGINT DEFAULT NULL")
    if person_id is None:
        mine = F.raise_error(F.lit("patient context is not set")).cast("boolean")
    else:
        session.sql(f"SET VAR current_person_id = {int(person_id)}")
        mine = F.col("person_id") == F.lit(int(person_id))
    outcome = tables["outcome"].where(mine)
    views = {"diseased_patient": tables["diseased_patient"].where(mine), "outcome": outcome,
             "indication": semi(tables["indication"], outcome.select("indication_id"), "indication_id")}
    for name in PATIENT_TABLES:
        views.get(name, tables[name]).createOrReplaceTempView(name)
