import datetime as dt

import pytest

from healthmart.plans import governed as GV

from .conftest import rows


def _tables(spark):
    person = spark.createDataFrame([
        (1, "Doe", "Jan", "M", 1, 58, 1, 10, dt.date(2020, 12, 12), dt.date(2020, 12, 22), True),
        (2, "Roe", "Kim", "F", 1, 45, 1, 6, None, None, False),
        (3, "Lone", "Nobody", "F", 1, 30, 1, 1, None, None, False)],
        "person_id long, last_name string, first_name string, gender string, primary_location_id long, age long, "
        "disease_id long, severity_value long, start_date date, end_date date, is_insured boolean")
    location = spark.createDataFrame([(1, "USA")], "location_id long, country_name string")
    disease = spark.createDataFrame([(1, "Flu")], "disease_id long, disease_name string")
    medicine = spark.createDataFrame([(5, "Drug")], "medicine_id long, name string")
    indication = spark.createDataFrame([(7, 5), (8, 5), (9, 5)], "indication_id long, medicine_id long")
    # two_people fixture: a shared indication (7) and one each
    outcome = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (2, 9)], "person_id long, indication_id long")
    return {"diseased_patient": person, "location": location, "disease": disease, "medicine": medicine,
            "indication": indication, "outcome": outcome}


def test_row_filters_show_only_own_rows(spark):
    t = _tables(spark)
    ctx = GV.PatientSession(1)
    assert rows(ctx.patient(t["diseased_patient"]), "person_id") == [(1,)]
    assert rows(ctx.outcome(t["outcome"])) == [(1, 7), (1, 8)]
    assert rows(ctx.indication(t["indication"], t["outcome"]), "indication_id") == [(7,), (8,)]


def test_unset_context_raises(spark):
    t = _tables(spark)
    with pytest.raises(GV.ContextNotSet):
        GV.PatientSession(None).outcome(t["outcome"])


def test_my_record_and_patient_without_outcomes(spark):
    # no_outcome fixture: person 3 has no outcome -> one row with NULL person_id in R6, no row in R1
    t = _tables(spark)
    args = (t["diseased_patient"], t["location"], t["disease"], t["outcome"], t["indication"], t["medicine"])
    assert len(rows(GV.my_record(GV.PatientSession(1), *args))) == 2
    lone = GV.my_record(GV.PatientSession(3), *args).collect()
    assert len(lone) == 1 and lone[0]["person_id"] is None and lone[0]["last_name"] == "Lone"
    rec = GV.medical_records(t["outcome"], t["diseased_patient"], t["disease"], t["indication"], t["medicine"],
                             t["location"])
    assert sorted(r["person_id"] for r in rec.collect()) == [1, 1, 2, 2]
    assert rec.columns == GV.RECORD_COLS


def test_role_sessions(spark):
    tabs = lambda s: {k: s.createDataFrame(v.collect(), v.schema) for k, v in _tables(spark).items()}
    doc = GV.role_session(spark, tabs, "doctor")
    assert doc.sql(f"SELECT COUNT(*) FROM {GV.DOCTOR_VIEW}").first()[0] == 4
    pat = GV.role_session(spark, tabs, "patient", person_id=2)
    assert [r[0] for r in pat.sql("SELECT person_id FROM diseased_patient").collect()] == [2]
    assert sorted(r[0] for r in pat.sql("SELECT indication_id FROM indication").collect()) == [7, 9]
    with pytest.raises(Exception):
        pat.sql("SELECT * FROM profit").collect()          # not granted to patients
    assert sorted(v.name for v in pat.catalog.listTables() if v.isTemporary) == sorted(GV.PATIENT_TABLES)
    assert [v.name for v in doc.catalog.listTables() if v.isTemporary] == [GV.DOCTOR_VIEW]
    assert {r[0] for t in ("diseased_patient", "outcome") for r in pat.table(t).select("person_id").collect()} == {2}
    assert pat.sql("SELECT current_person_id").first()[0] == 2
    GV.set_patient(pat, tabs(pat), 1)                      # the views follow the context
    assert sorted(r[0] for r in pat.sql("SELECT indication_id FROM indication").collect()) == [7, 8]
    unset = GV.role_session(spark, tabs, "patient")
    with pytest.raises(Exception):
        unset.sql("SELECT * FROM outcome").collect()       # unset context raises, never all rows
