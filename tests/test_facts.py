from decimal import Decimal

from pyspark.sql import functions as F

from healthmart.plans import facts as FT
from healthmart.plans import warehouse as W

from .naive import fact_disease_outcome_no_country_naive
from .conftest import SF001, rows


def _world(spark, persons, outcomes, supp):
    """persons: (id, gender, age, disease_id, location_id); outcomes: (person, indication, outcome);
    supp: (indication, cost_cents, profit_cents)."""
    person = spark.createDataFrame(persons, "person_id long, gender string, age long, disease_id long, "
                                            "primary_location_id long")
    disease = spark.createDataFrame([(1, "Flu", 7, "DT1"), (2, "Cold", 8, "DT1")],
                                    "disease_id long, disease_name string, intensity_level_qty long, disease_type_code string")
    location = spark.createDataFrame([(1, "A", "A", "X", "N", 1), (2, "B", "B", "Y", "Y", 2)],
                                     "location_id long, city_name string, state_province_name string, country_name string, "
                                     "developing_flag string, wealth_rank_number long")
    outcome = spark.createDataFrame(outcomes, "person_id long, indication_id long, outcome string")
    indication = spark.createDataFrame([(i,) for i, _, _ in supp], "indication_id long")
    profit = spark.createDataFrame(supp, "indication_id long, cost_cents long, profit_cents long")
    d_dis, d_gen, d_loc = W.dim_disease(disease), W.dim_gender(person), W.dim_location(location)
    cells = FT.person_cells(person, disease, d_dis, d_gen, location, d_loc)
    cells_nc = FT.person_cells(person, disease, d_dis, d_gen)
    return outcome, cells, cells_nc, indication, profit


def test_b2_rewrite_equals_naive_on_fanout(spark):
    # fanout fixture: a person with 3 outcomes over 2 distinct costs, another with one outcome
    o, _, cells, ind, prof = _world(
        spark, [(1, "M", 30, 1, 1), (2, "F", 75, 2, 2)],
        [(1, 10, "recovered"), (1, 11, "died"), (1, 12, "relapse"), (2, 10, "worsened")],
        [(10, 1000, 500), (11, 2000, -300), (12, 2000, 100)])
    fast = FT.fact_disease_outcome_no_country(o, cells, ind, prof)
    slow = fact_disease_outcome_no_country_naive(o, cells, ind, prof)
    assert rows(fast) == rows(slow)
    r = [x for x in fast.collect() if x["gender_id"] is not None and x["age_id"] == 3][0]
    # 3 outcomes x 2 cost rows: the reference's COUNT(*) is 6, each flag counted twice
    assert (r["recovered_count"], r["died_count"], r["relapsed_count"]) == (2, 2, 2)


def test_b1_weights_by_global_indication_frequency(spark):
    # weights fixture: indication 10 seen once, indication 20 three times in total
    o, cells, _, ind, prof = _world(
        spark, [(1, "M", 30, 1, 1), (2, "F", 40, 1, 1)],
        [(1, 10, "recovered"), (1, 20, "worsened"), (2, 20, "died"), (2, 20, "died")],
        [(10, 1000, 100), (20, 2000, 300)])
    fact = FT.fact_disease_outcome(o, cells, ind, prof)
    by_age = {r["age_id"]: r for r in fact.collect()}
    assert by_age[3]["avg_cost_per_drug"] == Decimal("17.50")  # (1*10 + 3*20) / (1 + 3)
    assert by_age[3]["avg_profit"] == Decimal("2.00")          # (1 + 3) / 2
    assert by_age[3]["effectiveness"] == Decimal("50.00")
    assert by_age[3]["overall_avg_cost"] == Decimal("15.00")


def test_effectiveness_counts_relapse_in_denominator(spark):
    # relapse fixture
    o, cells, _, ind, prof = _world(spark, [(1, "M", 30, 1, 1)],
                                    [(1, 10, "recovered"), (1, 10, "relapse")], [(10, 1000, 100)])
    r = FT.fact_disease_outcome(o, cells, ind, prof).first()
    assert (r["recovered_count"], r["relapsed_count"], r["effectiveness"]) == (1, 1, Decimal("50.00"))


def test_b1_counts_sum_to_outcomes_with_a_cell(spark):
    from healthmart import queries as Q
    from healthmart.sources.roles import role_views
    v = role_views(spark, SF001)
    fact = Q.REGISTRY["b1_fact_disease_outcome"].build(spark, SF001)
    total = fact.agg(sum(F.sum(c) for c in FT.COUNT_COLS)).first()[0]
    assert total == v.outcome().count()   # every test person has a complete cell
    ids = sorted(r[0] for r in fact.select("fact_disease_outcome_id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_b2_rewrite_equals_naive_on_test_tables(spark):
    from healthmart.sources.roles import role_views
    v = role_views(spark, SF001)
    person, cond = v.person(), v.condition()
    cells = FT.person_cells(person, cond, W.dim_disease(cond), W.dim_gender(person))
    args = (v.outcome(), cells, v.indication(), v.profit())
    assert rows(FT.fact_disease_outcome_no_country(*args)) == rows(fact_disease_outcome_no_country_naive(*args))


def test_scd_change_and_restatement_on_test_tables(spark):
    from healthmart import queries as Q
    fact = Q.REGISTRY["s1j_fact_restated"].build(spark, SF001)
    before = Q.REGISTRY["b3_fact_disease_intensity"].build(spark, SF001)
    changed = sorted(set(rows(fact)) - set(rows(before)))
    # only the changed disease's row in the first year of the new version differs
    assert len(changed) == 1
    dil = Q.REGISTRY["s1j_dim_after_change"].build(spark, SF001)
    cur = dil.where("is_current").groupBy("disease_name").count().where("count > 1").count()
    assert cur == 0   # at most one current version per key
    a, b = dil.alias("a"), dil.alias("b")
    overlap = a.join(b, (F.col("a.disease_name") == F.col("b.disease_name"))
                     & (F.col("a.intensity_level_scd_id") < F.col("b.intensity_level_scd_id"))
                     & (F.col("a.start_year") <= F.coalesce(F.col("b.end_year"), F.lit(9999)))
                     & (F.col("b.start_year") <= F.coalesce(F.col("a.end_year"), F.lit(9999))))
    assert overlap.count() == 0   # validity ranges of one key never overlap


def test_dim_medicine_collapses_after_merger(spark):
    # merger fixture: 3 shared ingredients, 2 unshared
    from healthmart.plans import kpi
    med = spark.createDataFrame([
        (1, "s1", "P-a", "Pharma", "a"), (2, "s2", "P-b", "Pharma", "b"), (3, "s3", "P-c", "Pharma", "c"),
        (4, "s4", "M-a", "Medi", "a"), (5, "s5", "M-b", "Medi", "b"), (6, "s6", "M-c", "Medi", "c"),
        (7, "s7", "M-x", "Medi", "x"), (8, "s8", "O-y", "Other", "y")],
        "medicine_id long, standard_industry_number string, name string, company string, active_ingredient_name string")
    assert len(rows(kpi.competing_products(med, ("Pharma", "Medi")))) == 6
    merged = kpi.merge_companies(med, "Pharma", "Medi")
    dim = W.dim_medicine(merged)
    assert dim.count() == 5   # 8 drugs, 3 renamed-and-moved pairs collapse
    lit_ind = spark.createDataFrame([(i, i, 1) for i in range(1, 9)], "indication_id long, medicine_id long, disease_id long")
    default = W.dim_indication(lit_ind, merged, dim)
    assert default.count() == 8 and default.where(F.col("medicine_id").isNull()).count() == 0   # T2: nothing lost
    literal = W.dim_indication(lit_ind, merged, dim, literal=True)
    assert literal.count() == 5   # the reference's id-to-surrogate comparison drops source ids 6-8


def test_wide_products_are_exact(spark):
    """A hot indication at the largest legal cost: products far beyond 64 bits."""
    n, cents = 40_000, 9_999_999_999
    o = spark.range(n).select((F.col("id") % 3).alias("person_id"), F.lit(1).cast("long").alias("indication_id"), F.lit("recovered").alias("outcome"))
    ind = spark.createDataFrame([(1,)], "indication_id long")
    prof = spark.createDataFrame([(1, cents, -cents)], "indication_id long, cost_cents long, profit_cents long")
    cells = spark.createDataFrame([(p, 1, 1, 1, 1) for p in range(3)], "person_id long, disease_id long, age_id long, gender_id long, location_id long")
    for fact in (FT.fact_disease_outcome(o, cells, ind, prof), FT.fact_disease_outcome_no_country(o, cells.drop("location_id"), ind, prof)):
        r = fact.first()
        assert (r["recovered_count"], str(r["effectiveness"]), str(r["avg_cost_per_drug"]), str(r["avg_profit"])) == (
            n, "100.00", "99999999.99", "-99999999.99")


def test_unknown_medicines_drop_their_indications(spark):
    med = spark.createDataFrame([(1, "n", "c")], "medicine_id long, name string, company string")
    ind = spark.createDataFrame([(1, 1, 1), (2, 77, 1), (3, None, 1)], "indication_id long, medicine_id long, disease_id long")
    assert rows(W.dim_indication(ind, med, W.dim_medicine(med))) == [(1, 1, 1)]


def test_star_reads_are_in_order_with_nulls(spark):
    """null_sort: NULL measures come first when descending and last when ascending."""
    measures = [(1, "1.00", "2.00"), (2, None, "1.00"), (3, "1.00", None), (4, "3.00", "5.00"), (5, "3.00", "9.00"), (6, None, None)]
    cols = ["fact_disease_outcome_id", "disease_id", "age_id", "gender_id", "location_id", *FT.COUNT_COLS, *FT.MEASURES]
    fact = spark.createDataFrame([(i, 1, 1, 1, 1, 0, 0, 0, 0, e, a, None, None) for i, e, a in measures],
                                 ", ".join(f"{c} {'string' if c in FT.MEASURES else 'long'}" for c in cols))
    d = spark.createDataFrame([(1, "d")], "disease_id long, disease_name string")
    age = spark.createDataFrame([(1, "0-10")], "age_id long, age_range string")
    g = spark.createDataFrame([(1, "M")], "gender_id long, gender string")
    loc = spark.createDataFrame([(1, "x")], "location_id long, country_name string")
    assert [r[0] for r in FT.star_outcome(fact, d, age, g, loc).collect()] == [6, 2, 5, 4, 3, 1]
    assert [r[0] for r in FT.star_outcome(fact, d, age, g).collect()] == [3, 1, 5, 4, 6, 2]
