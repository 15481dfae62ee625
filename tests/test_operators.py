import pytest
from pyspark.sql import functions as F

from healthmart.operators import (IntegrityError, lookup, not_in, remap_key, restate, scd2_apply, scd2_close,
                                  scd2_open, semi, update_from, update_where, valid_in, with_dense_id)
from healthmart.operators.integrity import apply_rules, dup_keys, orphans

from .conftest import rows


def test_semi_never_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k long")
    assert rows(semi(df, keys, "k")) == [(1,), (3,)]


def test_not_in_refuses_null_subquery(spark):
    # not_in_null fixture: SQL would return no row at all; we raise instead of going silently empty
    df = spark.createDataFrame([(1,), (2,)], "k long")
    keys = spark.createDataFrame([(1,), (None,)], "k long")
    with pytest.raises(IntegrityError):
        not_in(df, keys, "k")


def test_not_in_null_left_and_empty_right(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert rows(not_in(df, spark.createDataFrame([(1,)], "k long"), "k")) == [(2,)]
    # NOT IN over an empty set keeps every row, NULL included
    assert len(rows(not_in(df, spark.createDataFrame([], "k long"), "k"))) == 3


def test_lookup_semantics(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    dim = spark.createDataFrame([(1, "a")], "k long, v string")
    assert rows(lookup(df, dim, "k", ["v"])) == [(1, "a"), (2, None)]
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(IntegrityError):
        lookup(df, dup, "k", ["v"])


def test_update_where_reads_old_row_and_skips_null_predicate(spark):
    df = spark.createDataFrame([("Beta", "x"), ("Acme", "y"), (None, "z")], "company string, name string")
    out = update_where(df, F.col("company") == "Beta", {"company": "Acme", "name": F.col("company")})
    assert rows(out) == [("Acme", "Beta"), ("Acme", "y"), (None, "z")]


def test_update_from_duplicate_source_raises(spark):
    # dup_source fixture: two acquirer rows for one ingredient
    df = spark.createDataFrame([("ing", "old")], "ing string, name string")
    src = spark.createDataFrame([("ing", "a"), ("ing", "b")], "ing string, new string")
    with pytest.raises(IntegrityError):
        update_from(df, src, "ing", {"name": "new"})


def test_update_from_matched_null_overwrites(spark):
    # null_overwrite fixture
    df = spark.createDataFrame([("a", "old", "M"), ("b", "old", "M"), ("c", "old", "P"), (None, "old", "M")],
                               "ing string, name string, company string")
    src = spark.createDataFrame([("a", None), ("c", "new"), (None, "n")], "ing string, new string")
    out = update_from(df, src, "ing", {"name": "new"}, cond=F.col("company") == "M")
    assert rows(out) == [("a", None, "M"), ("b", "old", "M"), ("c", "old", "P"), (None, "old", "M")]


@pytest.mark.parametrize("at_most", [None, 200])
def test_dense_ids_follow_order(spark, at_most):
    df = spark.range(0, 200).select((F.col("id") * 7 % 200).alias("k"), F.lit("x").alias("v")).repartition(7)
    out = with_dense_id(df, ["k"], "sid", at_most=at_most)
    got = sorted((r["k"], r["sid"]) for r in out.collect())
    assert [sid for _, sid in got] == list(range(1, 201))   # 1..n, no gaps, in key order


def test_dense_ids_nulls_last_and_start(spark):
    df = spark.createDataFrame([(None,), (3,), (1,)], "k long")
    got = {r["k"]: r["sid"] for r in with_dense_id(df, ["k"], "sid", start=10).collect()}
    assert got == {1: 10, 3: 11, None: 12}


def test_valid_in_bounds(spark):
    # validity fixture: open end, closed, gap, overlap, year on both bounds
    years = spark.createDataFrame([(i + 1, y) for i, y in enumerate(range(2019, 2025))], "year_id long, year long")
    versions = spark.createDataFrame([
        ("open", 2022, None), ("closed", 2020, 2021), ("gap", 2030, 2031), ("empty", 2023, 2022),
        ("a", 2019, 2020), ("b", 2020, 2020)], "name string, start_year long, end_year long")
    got = rows(valid_in(years, versions), "name", "year")
    assert ("open", 2022) in got and ("open", 2024) in got and ("open", 2021) not in got
    assert [y for n, y in got if n == "closed"] == [2020, 2021]
    assert not [1 for n, _ in got if n in ("gap", "empty")]
    assert [y for n, y in got if n == "b"] == [2020]
    assert [y for n, y in got if n == "a"] == [2019, 2020]


def _dil(spark):
    return spark.createDataFrame([(1, "Disease-A", 7, 2020, 2025, True), (2, "Disease-B", 7, 2020, 2025, True)],
                                 "id long, disease_name string, intensity_level long, start_year long, "
                                 "end_year long, is_current boolean")


def test_scd2_close_then_open(spark):
    dil = _dil(spark)
    closed = scd2_close(dil, spark.createDataFrame([("Disease-A",)], "disease_name string"), "disease_name", 2022)
    opened = scd2_open(closed, spark.createDataFrame([("Disease-A", "9", 2023, 2025, True)],
                                                     "disease_name string, intensity_level string, start_year long, "
                                                     "end_year long, is_current boolean"), "id", {})
    assert rows(opened) == [(1, "Disease-A", 7, 2020, 2022, False), (2, "Disease-B", 7, 2020, 2025, True),
                            (3, "Disease-A", 9, 2023, 2025, True)]


def test_scd2_apply_changed_unchanged_new_duplicate(spark):
    # scd_change fixture
    dil = _dil(spark)
    ch = spark.createDataFrame([("Disease-A", 9), ("Disease-B", 7), ("Flu", 3)], "disease_name string, intensity_level long")
    out = scd2_apply(dil, ch, "disease_name", ["intensity_level"], 2023, "id", end_year=2025)
    got = rows(out)
    assert (1, "Disease-A", 7, 2020, 2022, False) in got
    assert (2, "Disease-B", 7, 2020, 2025, True) in got        # unchanged: untouched
    assert sorted(r[1:3] for r in got if r[0] > 2) == [("Disease-A", 9), ("Flu", 3)]
    assert sorted(r[0] for r in got) == [1, 2, 3, 4]
    dup = spark.createDataFrame([("Disease-A", 9), ("Disease-A", 8)], "disease_name string, intensity_level long")
    with pytest.raises(IntegrityError):
        scd2_apply(dil, dup, "disease_name", ["intensity_level"], 2023, "id")


def test_restate_only_covered_rows_and_idempotent(spark):
    # restate fixture: years before, in and after the new validity
    fact = spark.createDataFrame([(1, 1, 1, 10), (2, 2, 1, 10), (3, 3, 1, 10), (4, 1, 2, 20)],
                                 "fid long, year_id long, disease_id long, level_id long")
    cover = spark.createDataFrame([(2, 1, 99), (3, 1, None)], "year_id long, disease_id long, level_id long")
    once = restate(fact, cover, ["year_id", "disease_id"], "level_id", "level_id")
    assert rows(once) == [(1, 1, 1, 10), (2, 2, 1, 99), (3, 3, 1, None), (4, 1, 2, 20)]
    assert rows(restate(once, cover, ["year_id", "disease_id"], "level_id", "level_id")) == rows(once)
    two = spark.createDataFrame([(2, 1, 99), (2, 1, 98)], "year_id long, disease_id long, level_id long")
    with pytest.raises(IntegrityError):
        restate(fact, two, ["year_id", "disease_id"], "level_id", "level_id")


def test_remap_key_cascades(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, fk long")
    mapping = spark.createDataFrame([(10, 100)], "old_key long, new_key long")
    assert rows(remap_key(child, "fk", mapping)) == [(1, 100), (2, 11), (3, None)]


def test_integrity_reports(spark):
    # orphans fixture: bad FK, NULL FK (legal), duplicate PK
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk long")
    child = spark.createDataFrame([(1,), (3,), (None,)], "fk long")
    rep = orphans(child, "fk", parent, "pk", ("c", "fk", "p", "pk")).first()
    assert rep["orphan_rows"] == 1
    d = dup_keys(parent, ["pk"], "p").first()
    assert (d["duplicated_keys"], d["rows_with_duplicated_key"]) == (1, 2)


def test_apply_rules_defaults_and_violations(spark):
    df = spark.createDataFrame([(1, None, "toolongname", None), (2, "M", "ok", 3)],
                               "id long, gender string, name string, severity long")
    ok, bad = apply_rules(df, {"severity": 1}, ["gender"], {"name": 5, "gender": 1}, key=["id"])
    assert rows(ok, "id", "severity") == [(1, 1), (2, 3)]
    assert rows(bad) == [(1, "gender", "not null", None), (1, "name", "max length 5", 11)]


def test_dense_ids_split_a_hot_key(spark):
    # a third of the rows share one order value: ids stay 1..n and the hot value spans partitions
    df = spark.range(0, 300).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    out = with_dense_id(df, ["k"], "sid")
    got = sorted(r["sid"] for r in out.collect())
    assert got == list(range(1, 301))
    hot = sorted(r["sid"] for r in out.where("k = -1").collect())
    assert hot == list(range(1, 101))   # equal keys take consecutive ids


def test_dense_ids_are_a_function_of_the_rows(spark):
    """Tied order values: the same ids at any partitioning and input order, and as a fixed domain."""
    data = [(k, v) for k in (1, 1, 1, 2, 2, None) for v in "dacbe"]
    df = spark.createDataFrame(data, "k long, v string").distinct()
    want = rows(with_dense_id(df, ["k"], "sid", at_most=100))
    for parts in (1, 3, 9):
        shuffled = spark.createDataFrame(data[::-1], "k long, v string").distinct().repartition(parts)
        assert rows(with_dense_id(shuffled, ["k"], "sid")) == want


def test_a_fixed_domain_that_outgrows_its_bound_raises(spark):
    from healthmart.operators.keys import fixed_domain
    with pytest.raises(Exception, match="fixed domain"):
        with_dense_id(spark.range(6), ["id"], "sid", at_most=5).collect()
    with pytest.raises(Exception, match="fixed domain"):
        fixed_domain(spark.range(6), 5).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from healthmart.session import ensure_checkpoint_dir

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: d)}))

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster)


def test_places_follow_the_delivered_order(spark):
    from pyspark.sql import functions as F
    from healthmart.operators.keys import with_place
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("v"), "id").repartition(7)
    got = with_place(df.orderBy(F.col("v").desc(), "id"), "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 1001))
    assert [(r["v"], r["id"]) for r in got] == sorted(((i * 37 % 101, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
    assert with_place(df.limit(0).orderBy("v"), "place").count() == 0
