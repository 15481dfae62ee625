"""Jobs that change or maintain stored tables: cascades, dated changes, arrivals, scenarios, partials, layouts."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from healthmart import queries as Q
from healthmart.operators import IntegrityError, scd2_merge
from healthmart.operators.cascade import affected_columns, cascade, orphan_report
from healthmart.operators.checked import checked_append, split_batch
from healthmart.operators.integrity import orphans
from healthmart.operators.keys import scratch_path
from healthmart.plans import audience as AU
from healthmart.plans import facts as FT
from healthmart.plans import kpi
from healthmart.plans.incremental import OutcomeFacts, Partials, restate_years, store_by_year
from healthmart.plans.jobs import store_by_person
from healthmart.plans.scenarios import kpis_by_scenario
from healthmart.sources import Catalog
from healthmart.sources.roles import RoleViews, role_views
from healthmart.streaming.arrival import CatalogLookup, run_arrivals_as_of, write_arrivals_as_of

from .conftest import SF001, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- A11 -----------------------------------------------------------------------------------------------

def test_the_key_graph_is_walked():
    assert affected_columns("disease_type", "disease_type_code") == {"disease_type": ["disease_type_code"], "disease": ["disease_type_code"]}
    assert affected_columns("diseased_patient", "person_id") == {"diseased_patient": ["person_id"], "outcome": ["person_id"]}
    graph = [("b", "id", "a", "id"), ("c", "b1", "b", "id"), ("c", "b2", "b", "id"), ("d", "c", "c", "b1"), ("a", "id", "d", "c"), ("e", "x", "f", "x")]
    assert affected_columns("a", "id", graph) == {"a": ["id"], "b": ["id"], "c": ["b1", "b2"], "d": ["c"]}


def test_cascade_through_key_columns_and_swapped_keys(spark):
    cat = Catalog(spark, "hm_cascade_test")
    graph = [("b", "id", "a", "id"), ("c", "b1", "b", "id"), ("c", "b2", "b", "id"), ("absent", "x", "a", "id")]
    cat.replace_all({"a": spark.createDataFrame([(1,), (2,), (3,)], "id int"), "b": spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"),
                     "c": spark.createDataFrame([(1, 2), (2, None), (3, 1)], "b1 int, b2 int")})
    moves = spark.createDataFrame([(1, 2), (2, 1), (3, 30), (99, 5)], "old_key long, new_key long")     # 1 and 2 change places, 99 does not occur
    assert cascade(cat, "a", "id", moves, foreign_keys=graph) == {"a": ["id"], "b": ["id"], "c": ["b1", "b2"]}
    assert rows(cat.scan("a")) == [(1,), (2,), (30,)] and rows(cat.scan("b")) == [(1, "y"), (2, "x")]
    assert rows(cat.scan("c")) == [(1, None), (2, 1), (30, 2)]
    assert [f.dataType.simpleString() for f in cat.scan("c").schema] == ["int", "int"]
    before = {t: cat.version(t) for t in "abc"}
    for bad in ([(1, 30)], [(1, 7), (1, 8)], [(1, None)], [(None, 4)], [(1, 9), (2, 9)]):
        with pytest.raises(IntegrityError):
            cascade(cat, "a", "id", spark.createDataFrame(bad, "old_key long, new_key long"), foreign_keys=graph)
    assert {t: cat.version(t) for t in "abc"} == before


def test_orphan_report_equals_the_anti_joins(spark):
    tables = {"p": spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "c")], "id int, code string"),
              "c": spark.createDataFrame([(1, "a"), (5, "z"), (5, "z"), (None, None), (2, "q")], "p long, code string"), "empty": spark.createDataFrame([], "p long")}
    keys = [("c", "p", "p", "id"), ("c", "code", "p", "code"), ("empty", "p", "p", "id"), ("p", "id", "empty", "p")]
    want = [tuple(orphans(tables[c], fk, tables[p], pk, (c, fk, p, pk)).first()) for c, fk, p, pk in keys]
    assert sorted(tuple(r) for r in orphan_report(tables, keys).collect()) == sorted(want)
    v = role_views(spark, SF001)
    raw = {t: v.raw(t) for fk in Q.FK_CHECKS for t in (fk[0], fk[2])}
    assert plan_of(orphan_report(raw, Q.FK_CHECKS)).count("FileScan") == len(raw)      # each table once


# -- D4b -----------------------------------------------------------------------------------------------
DIM = "id long, name string, level long, start_year long, end_year long, is_current boolean"
CHANGES = "name string, level long, start_year long, end_year long"


def merged(spark, dim, changes):
    out = scd2_merge(spark.createDataFrame(dim, DIM), spark.createDataFrame(changes, CHANGES), "name", ["level"], "id")
    return sorted(tuple(r) for r in out.collect())


def test_dated_changes_split_versions(spark):
    dim = [(1, "a", 1, 2000, 2004, False), (2, "a", 2, 2008, 2012, True), (3, "b", 5, 2000, None, True)]
    assert merged(spark, dim, [("a", 9, 2002, None)]) == sorted(
        [(1, "a", 1, 2000, 2001, False), dim[1], dim[2], (4, "a", 9, 2002, 2004, False)])              # inside a closed version
    assert merged(spark, dim, [("a", 9, 2006, None)]) == sorted([*dim, (4, "a", 9, 2006, 2007, False)])   # in a gap
    assert merged(spark, dim, [("a", 9, 1990, None)]) == sorted([*dim, (4, "a", 9, 1990, 1999, False)])   # before the first
    assert merged(spark, dim, [("a", 9, 2010, 2020)]) == sorted(
        [dim[0], (2, "a", 2, 2008, 2009, False), dim[2], (4, "a", 9, 2010, 2020, True)])               # inside the current one
    assert merged(spark, dim, [("b", 6, 2000, None)]) == sorted([*dim[:2], (3, "b", 5, 2000, 1999, False), (4, "b", 6, 2000, None, True)])
    assert merged(spark, dim, [("a", 1, 2003, None), ("a", 2, 2010, 2020), ("b", 5, 2005, 2006)]) == dim   # nothing changes
    assert merged(spark, dim, [("c", 1, 2001, 2003), ("c", 2, 2005, None), ("c", 2, 2007, None)]) == sorted(
        [*dim, (4, "c", 1, 2001, 2004, False), (5, "c", 2, 2005, None, True)])                         # a new key
    assert merged(spark, dim, [(None, 1, 2001, None)]) == [*dim, (4, None, 1, 2001, None, True)]
    assert merged(spark, dim, []) == dim and merged(spark, [], [("a", 1, 2000, None)]) == [(1, "a", 1, 2000, None, True)]
    for bad in ([("a", 1, 2000, None), ("a", 2, 2000, None)], [("a", 1, None, None)]):
        with pytest.raises(IntegrityError):
            merged(spark, dim, bad)


def test_random_batches_against_year_tables(spark):
    """Whatever the versions and changes, every year shows the level that holds in it, and no year shows two."""
    rng = random.Random(7)
    dim, changes, i = [], [], 0
    for k in range(60):
        y, name, n = 2000, f"k{k}", rng.randint(0, 4)
        for j in range(n):
            y += rng.randint(0, 2)
            e = y + rng.randint(0, 3)
            i += 1
            last = j == n - 1
            dim.append((i, name, rng.randint(1, 3), y, None if last else e, last))
            y = e + 1
        changes += [(name, rng.randint(1, 3), s, None) for s in rng.sample(range(1998, 2020), rng.randint(0, 4))]
    want = {}
    by_name = {n: sorted((s, e, lv, cur) for _, m, lv, s, e, cur in dim if m == n) for n in {c[0] for c in changes} | {d[1] for d in dim}}
    for name, versions in by_name.items():
        mine = sorted((s, lv) for n, lv, s, _ in changes if n == name)
        for year in range(1995, 2031):
            here = [(s, lv) for s, e, lv, _ in versions if s <= year and (e is None or year <= e)]
            first = here[0][0] if here else max([e + 1 for s, e, _, _ in versions if e is not None and e < year], default=-1)
            since = [(s, lv) for s, lv in mine if first <= s <= year]
            level = since[-1][1] if since else here[0][1] if here else None
            if level is not None:
                want[name, year] = level
    got = {}
    for _, name, level, s, e, cur in merged(spark, dim, changes):
        for year in range(s, (2030 if e is None else e) + 1):
            assert (name, year) not in got
            got[name, year] = level
    assert got == want


def test_the_dimension_is_read_once(spark):
    from healthmart.operators.scd import scd2_versions
    path = scratch_path(spark, "scd-dim")
    spark.createDataFrame([(1, "a", 1, 2000, None, True)], DIM).write.parquet(path)
    dim, batch = spark.read.parquet(path), spark.createDataFrame([("a", 2, 2001, None)], CHANGES)
    assert plan_of(scd2_versions(dim, batch, "name", ["level"], "id")).count("FileScan") == 1


# -- A10 -----------------------------------------------------------------------------------------------

def test_waves_keep_the_lookup_of_their_arrival(spark):
    cat = Catalog(spark, "hm_arrival_test")
    cat.replace("lk", spark.createDataFrame([(10, 100)], "k long, m long"))
    lookup, src, out = CatalogLookup(cat, "lk", "k"), scratch_path(spark, "src"), scratch_path(spark, "out")
    wave = lambda i: spark.createDataFrame([(i, 10, 7), (i, 99, 7)], "wave long, k long, m long")
    wave(1).write.parquet(src)
    got = run_arrivals_as_of(spark, src, wave(1).schema, lookup, ("k", "k"), ["m"], out)
    assert rows(got) == [(1, 10, 100), (1, 99, None)] and got.columns == ["wave", "k", "m"]
    checked = lookup.checked
    assert lookup() is not None and lookup.checked == checked == cat.version("lk")
    cat.replace("lk", spark.createDataFrame([(10, 200)], "k long, m long"))
    wave(2).write.mode("append").parquet(src)
    got = run_arrivals_as_of(spark, src, wave(1).schema, lookup, ("k", "k"), ["m"], out)
    want = [(1, 10, 100), (1, 99, None), (2, 10, 200), (2, 99, None)]
    assert rows(got) == want and lookup.checked != checked
    write_arrivals_as_of(wave(1), 0, lookup, ("k", "k"), ["m"], out)          # a committed batch comes again
    assert rows(got) == want
    cat.replace("lk", spark.createDataFrame([(10, 1), (10, 2)], "k long, m long"))
    with pytest.raises(IntegrityError):
        lookup()


# -- C11 and C1-C3 -----------------------------------------------------------------------------------------

def test_both_scenarios_equal_the_twelve_queries(spark):
    got = {(r["scenario"], r["kpi"], r["company_name"]): (r["patients"], r["total_profit"]) for r in Q.REGISTRY["c11_both_scenarios"].build(spark, SF001).collect()}
    want = {}
    for scenario, prefix in (("before", ""), ("after", "c11_after_merger_")):
        for key, name in (("c1", "target_patients"), ("c2", "other_patients"), ("c3", "patients_per_company"), ("c4", "target_profit"), ("c5", "other_profit"),
                          ("c6", "profit_per_company")):
            for r in Q.REGISTRY[prefix + name if prefix else f"{key}_{name}"].build(spark, SF001).collect():
                company, value = (r[0], r[1]) if len(r) == 2 else (None, r[0])
                want[scenario, key, company] = (value, None) if key in ("c1", "c2", "c3") else (None, value)
    assert got == want


def test_scenarios_scan_outcomes_once(spark):
    v = role_views(spark, SF001)
    med = v.medicine()
    plan = plan_of(kpis_by_scenario(v.outcome(), v.indication(), v.profit(), {"a": med, "b": kpi.merger_move(med, "ASIA", "AMERICA")}, "ASIA"))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1


def kpi_fixture(spark):
    outcome = spark.createDataFrame([(1, 10, dt.date(2020, 1, 5)), (1, 11, dt.date(2020, 2, 5)), (2, 12, dt.date(2020, 1, 9)), (3, 99, None), (None, 10, dt.date(2020, 1, 1)),
                                     (4, None, dt.date(2020, 1, 1)), (1, 10, dt.date(2020, 1, 5)), (2 ** 40, 13, dt.date(2020, 3, 1))],
                                    "person_id long, indication_id long, outcome_date date")
    indication = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, 4)], "indication_id long, medicine_id long")
    medicine = spark.createDataFrame([(1, "T"), (2, "R"), (3, None), (4, "S")], "medicine_id long, company string")
    profit = spark.createDataFrame([(10, "1.50"), (11, "-2.00"), (12, "4.00")], "indication_id long, profit string").selectExpr("indication_id", "CAST(profit AS DECIMAL(10,2)) AS profit")
    return outcome, indication, medicine, profit


@pytest.mark.parametrize("company", ["T", "nobody"])
def test_scenarios_and_bitmaps_on_odd_rows(spark, company):
    """No company, unknown medicine, no person, no indication, no profit row, an id beyond 32 bits."""
    outcome, indication, medicine, profit = kpi_fixture(spark)
    known = outcome.where("indication_id IS NOT NULL")     # NOT IN over an empty set also keeps rows without an indication
    got = {(r["kpi"], r["company_name"]): (r["patients"], r["total_profit"]) for r in kpis_by_scenario(outcome, indication, profit, {"s": medicine}, company).collect()}
    want = {("c1", None): (kpi.c1_patients(outcome, medicine, indication, company).first()[0], None),
            ("c2", None): (kpi.c2_other_patients(known, medicine, indication, company).first()[0], None),
            ("c4", None): (None, kpi.c4_profit(outcome, medicine, indication, profit, company).first()[0]),
            ("c5", None): (None, kpi.c5_other_profit(outcome, medicine, indication, profit, company).first()[0])}
    want |= {("c3", r[0]): (r[1], None) for r in kpi.c3_patients_per_company(outcome, medicine, indication).collect()}
    want |= {("c6", r[0]): (None, r[1]) for r in kpi.c6_profit_per_company(outcome, medicine, indication, profit).collect()}
    assert got == want
    sets = AU.patient_bitmaps(outcome, medicine, indication)
    stored = {(r["kpi"], r["company_name"]): r["patients"] for r in AU.audience(sets, company).collect()}
    assert stored == {k: n for k, (n, _) in want.items() if k[0] in ("c1", "c2", "c3")}
    january = {(r["kpi"], r["company_name"]): r["patients"] for r in AU.audience(AU.in_months(sets, dt.date(2020, 1, 1), dt.date(2020, 1, 1)), "T").collect()}
    assert january == {("c1", None): 1, ("c2", None): 1, ("c3", "T"): 1, ("c3", None): 1}
    assert [r["patients"] for r in AU.audience(sets.limit(0), "T").collect()] == [0, 0]


# -- maintained facts ----------------------------------------------------------------------------------------

def test_partials_of_batches_add_up(spark):
    part = Partials(Catalog(spark, "hm_partials_test"), "p", ["k"])
    part.drop()
    one = spark.createDataFrame([(1, 2), (None, 3)], "k long, n long")
    assert part.merge("a", one) and part.merge("b", one) and part.merge("b", one)       # the same batch again replaces itself
    assert rows(part.sums()) == [(1, 4), (None, 6)]
    part.compact()
    assert not part.merge("a", one) and part.merge("c", one)
    assert rows(part.sums()) == [(1, 6), (None, 9)]
    part.compact()
    assert not part.merge("c", one) and rows(part.sums()) == [(1, 6), (None, 9)]
    with pytest.raises(ValueError):
        part.merge("folded", one)


def test_a_merge_reads_the_arrivals_only(spark):
    facts = OutcomeFacts(Catalog(spark, "hm_merge_test"))
    facts.drop()
    cells = "disease_id long, age_id long, gender_id long, location_id long, indication_id long, outcome string"
    facts.cells.merge("one", FT.outcome_partials(spark.createDataFrame([(1, 1, 1, 1, 5, "died")], cells)))
    before = set(facts.cells.cat.scan(facts.cells.table).inputFiles())
    facts.cells.merge("two", FT.outcome_partials(spark.createDataFrame([(1, 1, 1, 1, 5, "recovered")] * 2, cells)))
    assert before < set(facts.cells.cat.scan(facts.cells.table).inputFiles())            # nothing that was stored is rewritten
    assert rows(facts.cells.sums(), "rows", "recovered_count", "died_count") == [(3, 2, 1)]


def test_restatement_leaves_untouched_years_alone(spark):
    cat = Catalog(spark, "hm_by_year_test")
    fact = spark.createDataFrame([(i * 3 + j, i, j, 10) for i in range(5) for j in range(3)],
                                 "fact_disease_intensity_id long, year_id long, disease_id long, intensity_level_id long")
    store_by_year(cat, "f", fact)
    files = {f for f in cat.scan("f").inputFiles()}
    cover = spark.createDataFrame([(2, 1, 99), (3, 1, None), (1, 0, 10)], "year_id long, disease_id long, intensity_level_id long")
    assert restate_years(cat, "f", cover) == [2, 3]                                       # year 1 is covered but keeps its level
    after = {f for f in cat.scan("f").inputFiles()}
    assert {f for f in files if not any(f"year_id={y}/" in f for y in (2, 3))} <= after
    assert not any(f in after for f in files if any(f"year_id={y}/" in f for y in (2, 3)))
    want = sorted((i * 3 + j, i, j, 99 if (i, j) == (2, 1) else None if (i, j) == (3, 1) else 10) for i in range(5) for j in range(3))
    got = cat.scan("f").select(*fact.columns)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert restate_years(cat, "f", cover) == []


# -- layout and checked load -----------------------------------------------------------------------------------

def test_a_patient_read_opens_one_bucket(spark):
    cat = store_by_person(spark, SF001, "hm_by_person_test", 8)
    # Plans name the opened buckets only while scans that need no bucketing still count as bucketed.
    settings = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        one = cat.scan("outcome").where("person_id = 1")
        assert "SelectedBucketsCount: 1 out of 8" in plan_of(one) and "EqualTo(person_id,1)" in plan_of(one)
        plan = plan_of(Q.REGISTRY["r6_own_record_by_layout"].build(spark, SF001))
        assert plan.count("SelectedBucketsCount: 1 out of 16") >= 2 and "SelectedBucketsCount: 16" not in plan
        # The doctor's record joins both bucket by bucket.
        both = cat.scan("outcome").select("person_id").join(cat.scan("diseased_patient").select("person_id", "age"), "person_id")
        assert "Exchange" not in plan_of(both)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert rows(one) == rows(Q.REGISTRY["r3_own_outcome_rows"].build(spark, SF001))


def test_a_batch_is_split_by_the_declared_rules(spark):
    kind = "outcome_id long, person_id long, indication_id long, outcome string"
    batch = spark.createDataFrame([(1, 1, 1, "died"), (2, 9, None, "x" * 31), (3, 1, 8, None), (4, 1, 1, "a"), (4, 1, 1, "a"), (None, 1, 1, "b"), (5, None, None, None), (6, 1, 1, "c")], kind)
    parents = {"diseased_patient": spark.createDataFrame([(1,), (1,), (None,)], "person_id long"), "indication": spark.createDataFrame([(1,)], "indication_id long")}
    stored = spark.createDataFrame([(6,), (None,)], "outcome_id long")
    good, bad = split_batch(batch, "outcome", stored, parents)
    assert rows(good, "outcome_id") == [(1,), (5,)] and good.columns == [f.name for f in Q.SCHEMAS["outcome"].fields]
    why = sorted((r["outcome_id"] or 0, r["reasons"]) for r in bad.collect())
    assert why == [(0, ["outcome_id: not null"]), (2, ["outcome: longer than 30", "person_id: no such diseased_patient"]), (3, ["indication_id: no such indication"]),
                   (4, ["outcome_id: twice in the batch"]), (4, ["outcome_id: twice in the batch"]), (6, ["outcome_id: already stored"])]
    good, bad = split_batch(batch.limit(0), "outcome", None, {})
    assert good.count() == bad.count() == 0


def test_accepted_and_rejected_add_up(spark):
    cat = Catalog(spark, "hm_checked_test")
    for t in ("indication", "indication__rejected", "medicine"):
        cat.drop(t)
    cat.replace("medicine", spark.createDataFrame([(1,), (2,)], "medicine_id long"))
    first = spark.createDataFrame([(1, 1), (2, 7), (3, None)], "indication_id long, medicine_id long")
    assert checked_append(cat, "indication", first) == (2, 1)
    assert checked_append(cat, "indication", first.where("indication_id < 3").withColumn("medicine_id", F.lit(2))) == (1, 1)
    assert rows(cat.scan("indication"), "indication_id", "medicine_id") == [(1, 1), (2, 2), (3, None)]
    assert rows(cat.scan("indication__rejected").select("indication_id", F.concat_ws(",", "reasons"))) == [(1, "indication_id: already stored"), (2, "medicine_id: no such medicine")]


# -- runs of the registered queries that store tables --------------------------------------------------------

def test_leftover_folders_and_other_runs_do_not_disturb_a_query_that_stores_tables(spark):
    # What a driver with a catalog of its own leaves in the shared warehouse.
    home = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    for folder in ("healthmart_cascade.db/diseased_patient", "healthmart_maintained.db/outcome_cell_partials", "healthmart_by_person.db/outcome"):
        os.makedirs(f"{home}/{folder}", exist_ok=True)
        with open(f"{home}/{folder}/left", "w") as f:
            f.write("left")
    first = Q.REGISTRY["a11_cascade_outcome"].build(spark, SF001)
    report = Q.REGISTRY["a11_cascade_report"].build(spark, SF001)
    assert first.count() == {r["table_name"]: r["n_rows"] for r in report.collect()}["outcome"] > 0
    assert rows(Q.REGISTRY["b1_fact_from_partials"].build(spark, SF001)) == rows(Q.REGISTRY["b1_fact_disease_outcome"].build(spark, SF001))
    assert rows(Q.REGISTRY["r6_own_record_by_layout"].build(spark, SF001)) == rows(Q.REGISTRY["r6_patient_own_record"].build(spark, SF001))


def test_arrivals_are_joined_once_and_sources_may_repeat_a_person(spark, tmp_path, monkeypatch):
    from healthmart import change_queries as CQ
    for t in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        df = spark.read.parquet(f"{SF001}/{t}.parquet")
        # Some persons come twice, some orders have no known person, some line items no date.
        if t == "customer":
            df = df.unionByName(df.where("c_custkey % 10 = 0"))
        if t == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_custkey")))
        if t == "lineitem":
            df = df.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 8 == 0, F.lit(None)).otherwise(F.col("l_shipdate")))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    reads, outcome_with = [], RoleViews.outcome_with
    monkeypatch.setattr(RoleViews, "outcome_with", lambda self, *a, **k: reads.append("with") or outcome_with(self, *a, **k))
    monkeypatch.setattr(RoleViews, "outcome", lambda self: reads.append("outcome"))
    facts, v, cells = CQ._maintained(spark, str(tmp_path))
    assert reads == ["with"]
    monkeypatch.undo()
    facts.cells.compact()
    assert rows(facts.fact(v.indication(), v.profit())) == rows(Q.REGISTRY["b1_fact_disease_outcome"].build(spark, str(tmp_path)))
    assert rows(facts.fact_no_country(cells, v.profit())) == rows(Q.REGISTRY["b2_fact_outcome_no_country"].build(spark, str(tmp_path)))
