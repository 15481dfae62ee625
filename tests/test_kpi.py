from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from healthmart.plans import kpi
from healthmart.operators import IntegrityError

from .conftest import SF001, rows


def _tables(spark):
    medicine = spark.createDataFrame([(1, "A", "Acme"), (2, "B", "Beta"), (3, "C", None), (4, "D", "Empty")],
                                     "medicine_id long, name string, company string")
    indication = spark.createDataFrame([(10, 1), (20, 2), (30, 3), (40, 4)], "indication_id long, medicine_id long")
    outcome = spark.createDataFrame([(1, 10), (1, 20), (2, 20), (3, 30), (3, 30)], "person_id long, indication_id long")
    profit = spark.createDataFrame([(10, Decimal("1.50")), (20, Decimal("2.00")), (30, Decimal("4.00")), (40, Decimal("9.99"))],
                                   "indication_id long, profit decimal(10,2)")
    return outcome, medicine, indication, profit


def test_kpis_and_null_company_rules(spark):
    # empty_company fixture: a company with no outcome and a NULL company (T5)
    o, m, i, p = _tables(spark)
    assert kpi.c1_patients(o, m, i, "Acme").first()[0] == 1
    assert kpi.c2_other_patients(o, m, i, "Acme").first()[0] == 3    # NOT IN keeps the NULL company
    assert kpi.c4_profit(o, m, i, p, "Acme").first()[0] == Decimal("1.50")
    assert kpi.c5_other_profit(o, m, i, p, "Acme").first()[0] == Decimal("4.00")   # != drops NULL company
    assert kpi.c4_profit(o, m, i, p, "Empty").first()[0] is None           # SUM over nothing is NULL
    per = dict(rows(kpi.c6_profit_per_company(o, m, i, p)))
    assert per == {"Acme": Decimal("1.50"), "Beta": Decimal("4.00"), None: Decimal("8.00")}
    assert dict(rows(kpi.c3_patients_per_company(o, m, i))) == {"Acme": 1, "Beta": 2, None: 1}


def test_c4_plus_c5_is_total_profit_on_test_tables(spark):
    from healthmart.sources.roles import role_views
    v = role_views(spark, SF001)
    args = (v.outcome(), v.medicine(), v.indication(), v.profit())
    total = sum(r[1] for r in kpi.c6_profit_per_company(*args).collect())
    c4 = kpi.c4_profit(*args, "ASIA").first()[0]
    c5 = kpi.c5_other_profit(*args, "ASIA").first()[0]
    assert c4 + c5 == total


def test_merger_keeps_total_profit(spark):
    from healthmart.sources.roles import role_views
    v = role_views(spark, SF001)
    before = kpi.c6_profit_per_company(v.outcome(), v.medicine(), v.indication(), v.profit())
    merged = kpi.merge_companies(v.medicine(), "ASIA", "AMERICA")
    after = kpi.c6_profit_per_company(v.outcome(), merged, v.indication(), v.profit())
    assert sum(r[1] for r in before.collect()) == sum(r[1] for r in after.collect())
    assert after.count() == before.count() - 1


def test_merger_rename_requires_unique_or_deduplicated_source(spark):
    med = spark.createDataFrame([(1, "s", "P1", "P", "ing"), (2, "s", "P2", "P", "ing"), (3, "s", "M1", "M", "ing")],
                                "medicine_id long, standard_industry_number string, name string, company string, "
                                "active_ingredient_name string")
    out = kpi.merger_rename(med, "P", "M")   # the acquirer sells two names: the smallest is taken
    assert rows(out, "medicine_id", "name") == [(1, "P1"), (2, "P2"), (3, "P1")]
    from healthmart.operators import update_from
    src = med.where("company = 'P'").select("active_ingredient_name", F.col("name").alias("pn"))
    with pytest.raises(IntegrityError):
        update_from(med, src, "active_ingredient_name", {"name": "pn"})


def test_competing_outcomes_is_a_stable_sample(spark):
    from healthmart import queries as Q
    a = rows(Q.REGISTRY["c8_competing_outcomes"].build(spark, SF001))
    b = rows(Q.REGISTRY["c8_competing_outcomes"].build(spark, SF001))
    assert a == b and len(a) <= 20


def test_sql_surface_matches_dataframe_jobs(spark):
    from healthmart.sources.roles import register_views
    spark = spark.newSession()      # its temp views stay out of the other tests' sight
    v = register_views(spark, SF001)
    by_sql = spark.sql("""
        SELECT m.company AS company_name, SUM(p.profit) AS total_profit
        FROM outcome o JOIN indication i ON i.indication_id = o.indication_id
        JOIN medicine m ON m.medicine_id = i.medicine_id
        JOIN profit p ON p.indication_id = o.indication_id
        GROUP BY m.company""")
    by_df = kpi.c6_profit_per_company(v.outcome(), v.medicine(), v.indication(), v.profit())
    assert dict(rows(by_sql)) == dict(rows(by_df))
    # names resolve case-insensitively, as unquoted names do in the reference (P10)
    assert spark.sql("SELECT COUNT(*) FROM Diseased_Patient WHERE Person_ID = 1").first()[0] == 1
