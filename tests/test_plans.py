"""Plan checks: the shapes that must hold at any scale."""

import contextlib
import io
import re

import pytest

from healthmart import queries as Q
from healthmart.plans import facts as FT

from .conftest import SF001


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables a query writes on its way (numbered facts): they are part of what runs."""
    import healthmart.operators.keys as K
    plans, freeze = [], K.freeze

    def spy(df, tag="frozen"):
        plans.append(_explain(df))
        return freeze(df, tag)

    for module in (K, FT, Q):
        monkeypatch.setattr(module, "freeze", spy)
    return plans


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def plan(df, written=()) -> str:
    return "\n".join([*written, _explain(df)])


@pytest.mark.parametrize("name", ["c1_target_patients", "c2_other_patients", "c3_patients_per_company",
                                  "c4_target_profit", "c6_profit_per_company", "b1_fact_disease_outcome",
                                  "b2_fact_outcome_no_country", "b3_fact_disease_intensity", "s1j_fact_restated",
                                  "r1_medical_records_doctor", "r6_patient_own_record", "a10_enrich_outcomes_batch"])
def test_no_cartesian_or_nested_loop(spark, written, name):
    p = plan(Q.REGISTRY[name].build(spark, SF001), written)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_kpi_scan_is_pruned(spark):
    p = plan(Q.REGISTRY["c6_profit_per_company"].build(spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all(s == "struct<l_orderkey:bigint,l_suppkey:bigint>" for s in li)


def test_patient_filter_reaches_the_scan(spark):
    p = plan(Q.REGISTRY["r6_patient_own_record"].build(spark, SF001))
    assert "EqualTo(c_custkey,1)" in p
    assert "EqualTo(o_custkey,1)" in p


def test_not_in_is_a_plain_anti_join(spark):
    p = plan(Q.REGISTRY["c2_other_patients"].build(spark, SF001))
    assert "LeftAnti" in p and "isnull" not in p.split("LeftAnti")[1].split("\n")[0].lower()


def test_range_join_is_an_equi_join(spark, written):
    p = plan(Q.REGISTRY["b3_fact_disease_intensity"].build(spark, SF001), written)
    assert "Generate" in p and "explode" in p


def test_fact_joins_line_items_once(spark, written):
    # B1: line items are read once, for the frequency and for the fact.
    p = plan(Q.REGISTRY["b1_fact_disease_outcome"].build(spark, SF001), written)
    assert "CartesianProduct" not in p
    assert p.count("lineitem.parquet") == 1


SMALL_DIM_KEYS = ("c_mktsegment", "_seg", "_dsrc", "src_id", "primary_location_id", "medicine_id",
                  "disease_name", "gender", "_a_")


@pytest.mark.parametrize("name", ["c1_target_patients", "c2_other_patients", "c3_patients_per_company",
                                  "c6_profit_per_company", "b1_fact_disease_outcome", "b2_fact_outcome_no_country",
                                  "s1j_fact_restated", "m9_dim_diseased_patient", "r1_medical_records_doctor",
                                  "r6_patient_own_record", "a10_enrich_outcomes_batch"])
def test_large_scale_plans_never_shuffle_on_small_dimension_keys(spark, written, name):
    """Planned as if every table were too big for the planner to broadcast: only the hints
    backed by a bound (fixed-size tables, exact counts) remain, and the remaining shuffles are on
    order, person and indication keys - never all rows onto a handful of dimension keys."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q.REGISTRY[name].build(spark, SF001), written)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    # Aggregations on few keys are fine (map-side partial aggregation); shuffle *joins* are not.
    joins = re.findall(r"\(\d+\) (?:SortMergeJoin|ShuffledHashJoin)[^\n]*\nLeft keys \[\d+\]: \[([^\]]*)\]", p)
    bad = [k for k in joins if any(re.search(rf"\b{d}", k) for d in SMALL_DIM_KEYS)]
    assert not bad, bad
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_colocated_tables_join_without_shuffle(spark):
    """Line items and orders bucketed by order key: the outcome view's join needs no exchange,
    even when nothing may be broadcast, and the KPIs are unchanged."""
    from healthmart.plans import kpi
    from healthmart.plans.jobs import store_colocated
    from healthmart.sources.roles import role_views
    store_colocated(spark, SF001, "hm_colocated_test", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        v = role_views(spark, SF001, "hm_colocated_test")
        p = plan(v.outcome())
        assert "SortMergeJoin" in p and "Exchange" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    files, tables = role_views(spark, SF001), role_views(spark, SF001, "hm_colocated_test")
    a = kpi.c6_profit_per_company(files.outcome(), files.medicine(), files.indication(), files.profit()).collect()
    b = kpi.c6_profit_per_company(tables.outcome(), tables.medicine(), tables.indication(), tables.profit()).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("name", ["c1_target_patients", "c2_other_patients", "c4_target_profit", "c5_other_profit", "m8_dim_year"])
def test_line_items_are_shuffled_once_at_most(spark, written, name):
    """With broadcasts off, line items meet the orders; what follows works on pairs or counts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q.REGISTRY[name].build(spark, SF001), written)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    before = re.findall(r"Exchange\nInput[^\n]*\nArguments: hashpartitioning\(([^)]*)\)", p)
    raw = [k for k in before if "l_orderkey" in k]
    assert len(raw) <= 1
    if name == "m8_dim_year":
        assert "orders.parquet" not in p
