"""Warehouse jobs: the reference's script order as Spark jobs writing catalog tables.

``build_warehouse`` = merger updates on the operational medicine table (S2), dimension loads
(S3), fact loads (S4); ``apply_intensity_change`` = SCD-2 close/open and fact restatement.
Each table is written whole (drop-and-rebuild, A4) into one namespace (A5), as a new version that
takes the table's name when it is complete, so a table may be computed from itself.  Facts read the dimensions back from the catalog, so keys are fixed before use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.roles import TEST_TABLES, role_views
from ..sources.tables import Catalog
from . import facts as FT
from . import kpi
from . import warehouse as W


def build_warehouse(spark: SparkSession, sf_dir: str, namespace: str = "healthmart_dw",
                    acquirer: str = "ASIA", acquired: str = "AMERICA") -> Catalog:
    v = role_views(spark, sf_dir)
    cat = Catalog(spark, namespace)
    person, cond, loc = v.person(with_dates=True), v.condition(), v.location()
    # One medicine table for both dimensions that read it.
    medicine = kpi.merge_companies(v.medicine(), acquirer, acquired)

    d_age = cat.replace("dim_age", W.dim_age(person))
    d_disease = cat.replace("dim_disease", W.dim_disease(cond))
    d_med = cat.replace("dim_medicine", W.dim_medicine(medicine))
    cat.replace("dim_indication", W.dim_indication(v.indication(), medicine, d_med))
    d_gender = cat.replace("dim_gender", W.dim_gender(person))
    d_loc = cat.replace("dim_location", W.dim_location(loc))
    cat.replace("dim_profit", W.dim_profit(v.profit()))
    d_year = cat.replace("dim_year", W.dim_year(v.outcome_lines()))
    cat.replace("dim_diseased_patient", W.dim_diseased_patient(person, d_gender, d_age))
    d_level = cat.replace("dim_intensity_level_quantity", W.dim_intensity_level(cond))
    dil = cat.replace("dim_disease_intensity_level", W.dim_disease_intensity(cond, d_disease, d_level))

    cells = FT.person_cells(person, cond, d_disease, d_gender, loc, d_loc, fixed_domains=True)
    lines = v.outcome_with(cells, how="left", cols=("indication_id", "outcome"))
    cat.replace("fact_disease_outcome", FT.fact_disease_outcome_from_lines(lines, v.indication(), v.profit()))
    cells_nc = FT.person_cells(person, cond, d_disease, d_gender, fixed_domains=True)
    cat.replace("fact_disease_outcome_no_country",
                FT.fact_disease_outcome_no_country(v.outcome(), cells_nc, v.indication(), v.profit()))
    cat.replace("fact_disease_intensity", FT.fact_disease_intensity(d_year, dil, d_disease, d_level))
    return cat


def apply_intensity_change(cat: Catalog, disease_name: str, level: str, from_year: int,
                           to_year: int | None) -> None:
    """S1j on the catalog tables: close + open in the SCD dimension, then restate the fact."""
    d_disease, d_year = cat.scan("dim_disease"), cat.scan("dim_year")
    d_level = cat.scan("dim_intensity_level_quantity")
    dil = FT.change_intensity(cat.scan("dim_disease_intensity_level"), d_disease, disease_name, level,
                              from_year, to_year)
    dil = cat.replace("dim_disease_intensity_level", dil)
    fact = FT.restate_intensity(cat.scan("fact_disease_intensity"), d_year, dil, d_disease, d_level)
    cat.replace("fact_disease_intensity", fact)


# Bucket keys of the co-located layout: line items and orders meet on the order key in every
# outcome query, which makes that join the dominant shuffle at scale.
COLOCATED_BUCKETS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def store_colocated(spark: SparkSession, sf_dir: str, namespace: str, buckets: int) -> Catalog:
    """Store the source tables as catalog tables, with line items and orders bucketed (and
    sorted) by order key into the same number of buckets.  Role views read with
    ``role_views(spark, sf_dir, namespace)`` then join them bucket by bucket, without a shuffle.
    The bucket count should give buckets of a few hundred MB at the target scale."""
    v = role_views(spark, sf_dir)
    cat = Catalog(spark, namespace)
    for name in TEST_TABLES:
        df = v.raw(name)
        writer = df.write.mode("overwrite").format("parquet")
        if name in COLOCATED_BUCKETS:
            key = COLOCATED_BUCKETS[name]
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(cat.name(name))
    return cat


# The patient reads (R2-R6) ask for one person: stored by person, they open one bucket.
BY_PERSON = {"outcome": "person_id", "diseased_patient": "person_id"}


def store_by_person(spark: SparkSession, sf_dir: str, namespace: str, buckets: int) -> Catalog:
    """Store the operational tables that the governed reads use, with outcomes and patients bucketed and sorted by
    person.  A read of one person then opens one bucket of each, and the sort lets Parquet skip inside it;
    the doctor's record joins the two bucket by bucket."""
    v = role_views(spark, sf_dir)
    cat = Catalog(spark, namespace)
    tables = {"outcome": v.outcome(), "diseased_patient": v.person(with_dates=True), "indication": v.indication(),
              "medicine": v.medicine(), "location": v.location(), "disease": v.condition()}
    for name, df in tables.items():
        key = BY_PERSON.get(name)
        writer = (df if key is None else df.repartition(buckets, key)).write.mode("overwrite").format("parquet")
        if key is not None:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(cat.name(name))
    return cat
