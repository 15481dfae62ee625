import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from healthmart.sources import SCHEMAS, Catalog, append_rows, load
from healthmart.plans.jobs import apply_intensity_change, build_warehouse

from healthmart.plans import kpi
from healthmart.sources.roles import role_views

from .conftest import SF001, rows


def test_load_csv_applies_schema_defaults_and_char_trim(spark):
    d = tempfile.mkdtemp(prefix="hm-load-")
    path = os.path.join(d, "patients.csv")
    with open(path, "w") as f:
        f.write("person_id,last_name,first_name,gender,primary_location_id,age,disease_id,start_date,end_date\n")
        f.write("1,Doe,Jan,M ,6,58,1,2020-12-12,2020-12-22\n")
    df = load(spark, path, "diseased_patient", fmt="csv", options={"header": "true"})
    assert df.schema == SCHEMAS["diseased_patient"] or [f.name for f in df.schema] == SCHEMAS["diseased_patient"].names
    r = df.first()
    assert (r["gender"], r["severity_value"], r["is_insured"], r["start_date"]) == ("M", 1, False, dt.date(2020, 12, 12))


def test_append_rows_casts_text_explicitly(spark):
    dil = spark.createDataFrame([(1, "Disease-A", 7)], "id long, disease_name string, intensity_level long")
    out = append_rows(spark, dil, [{"id": 2, "disease_name": "Disease-A", "intensity_level": "9"}])
    assert rows(out) == [(1, "Disease-A", 7), (2, "Disease-A", 9)]
    with pytest.raises(Exception):
        append_rows(spark, dil, [{"id": 3, "intensity_level": "x"}]).collect()


def test_catalog_rebuild_append_and_self_replace(spark):
    cat = Catalog(spark, "hm_test_ns")
    cat.replace("t", spark.createDataFrame([(1, "a")], "k long, v string"))
    cat.replace("t", spark.createDataFrame([(1, "a")], "k long, v string"))   # rerun: same state
    cat.append("t", spark.createDataFrame([(2,)], "k long"))                  # absent column -> NULL
    assert rows(cat.scan("t")) == [(1, "a"), (2, None)]
    cat.replace("t", cat.scan("t").where("k > 1"))
    assert rows(cat.scan("t")) == [(2, None)]
    with pytest.raises(Exception):
        cat.replace("t", cat.scan("t").withColumn("k", F.raise_error(F.lit("broken"))))
    assert rows(cat.scan("t")) == [(2, None)]                                 # the old version stays
    assert [x.name for x in spark.catalog.listTables("hm_test_ns") if not x.isTemporary] == ["t"]


def test_catalog_swap_of_several_tables(spark, monkeypatch):
    one = spark.createDataFrame([(1,)], "k long")
    cat = Catalog(spark, "hm_swap_ns")
    cat.replace_all({"a": one, "b": one})
    first = cat.version("a")
    assert first and cat.version("b") == first
    with pytest.raises(Exception):                                            # a failed write changes neither
        cat.replace_all({"a": one.union(one), "b": one.withColumn("k", F.raise_error(F.lit("broken")))})
    assert (cat.scan("a").count(), cat.version("a")) == (1, first)
    # A driver that dies between the renames: recover() finishes the swap.
    real, calls = Catalog._swap, []

    def dies(self, table, version):
        calls.append(table)
        if len(calls) == 2:
            raise KeyboardInterrupt
        real(self, table, version)

    monkeypatch.setattr(Catalog, "_swap", dies)
    with pytest.raises(KeyboardInterrupt):
        cat.replace_all({"a": one.union(one), "b": one.union(one), "c": one})
    monkeypatch.undo()
    assert (cat.scan("a").count(), cat.scan("b").count()) == (2, 1)
    cat.recover()
    assert [cat.scan(t).count() for t in "abc"] == [2, 2, 1] and len({cat.version(t) for t in "abc"}) == 1
    # A driver that dies before the first rename: the new versions go.
    monkeypatch.setattr(Catalog, "_swap", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        cat.replace_all({"a": one, "b": one})
    monkeypatch.undo()
    cat.recover()
    assert [cat.scan(t).count() for t in "abc"] == [2, 2, 1]
    assert sorted(x.name for x in spark.catalog.listTables("hm_swap_ns") if not x.isTemporary) == ["a", "b", "c"]


def test_warehouse_job_matches_registered_queries(spark):
    from healthmart import queries as Q
    cat = build_warehouse(spark, SF001, namespace="hm_dw_test")
    for table, query in [("dim_age", "m1_dim_age"), ("dim_disease", "m2_dim_disease"),
                         ("dim_indication", "m4_dim_indication"), ("dim_gender", "m5_dim_gender"),
                         ("dim_location", "m6_dim_location"), ("dim_year", "m8_dim_year"),
                         ("dim_diseased_patient", "m9_dim_diseased_patient"),
                         ("fact_disease_outcome", "b1_fact_disease_outcome"),
                         ("fact_disease_outcome_no_country", "b2_fact_outcome_no_country"),
                         ("fact_disease_intensity", "b3_fact_disease_intensity")]:
        assert rows(cat.scan(table)) == rows(Q.REGISTRY[query].build(spark, SF001)), table
    from healthmart.operators.integrity import orphans
    for child, fk, parent, pk in [("dim_indication", "medicine_id", "dim_medicine", "medicine_id"),
                                  ("fact_disease_outcome", "location_id", "dim_location", "location_id"),
                                  ("fact_disease_intensity", "year_id", "dim_year", "year_id")]:
        assert orphans(cat.scan(child), fk, cat.scan(parent), pk, (child, fk, parent, pk)).first()["orphan_rows"] == 0
    # The stored id of an indication's medicine is that of its own drug.
    v = role_views(spark, SF001)
    own = v.indication().join(v.medicine().select("medicine_id", "name"), "medicine_id").select("indication_id", "name")
    stored = cat.scan("dim_indication").join(cat.scan("dim_medicine"), "medicine_id").select("indication_id", "medicine_name")
    renamed = kpi.merge_companies(v.medicine(), "ASIA", "AMERICA").select("medicine_id", F.col("name").alias("new"))
    want = v.indication().join(renamed, "medicine_id").select("indication_id", F.col("new"))
    assert rows(stored) == rows(want) and own.count() == stored.count()
    apply_intensity_change(cat, *Q.SCD_CHANGE)
    assert rows(cat.scan("fact_disease_intensity")) == rows(Q.REGISTRY["s1j_fact_restated"].build(spark, SF001))
    assert rows(cat.scan("dim_disease_intensity_level")) == rows(Q.REGISTRY["s1j_dim_after_change"].build(spark, SF001))
