from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from healthmart.functions import (AGE_LABELS, age_bucket, age_range, gender_desc, half_up_div,
                                  hundredths_to_money, outcome_is, ratio_money, to_int_strict)


def test_age_buckets_agree_on_edges(spark):
    # age_edges fixture: NULL, -1, 0, 10, 11, 70, 71
    df = spark.createDataFrame([(None,), (-1,), (0,), (10,), (11,), (70,), (71,)], "age long")
    got = df.select("age", age_range(F.col("age")).alias("r"), age_bucket(F.col("age")).alias("b")).collect()
    by_age = {r["age"]: (r["r"], r["b"]) for r in got}
    assert by_age[None] == ("71+", 8)      # NULL falls to the ELSE branch
    assert by_age[-1] == ("0-10", 1)
    assert by_age[0] == ("0-10", 1)
    assert by_age[10] == ("0-10", 1)       # upper bounds are inclusive
    assert by_age[11] == ("11-20", 2)
    assert by_age[70] == ("61-70", 7)
    assert by_age[71] == ("71+", 8)
    for label, bucket in by_age.values():   # X1 and X2 agree (T1)
        assert AGE_LABELS[bucket - 1] == label


def test_gender_descriptions(spark):
    df = spark.createDataFrame([("M",), ("F",), ("X",), (None,)], "g string")
    got = {r["g"]: r["d"] for r in df.select("g", gender_desc(F.col("g")).alias("d")).collect()}
    assert got == {"M": "Male", "F": "Female", "X": "Unknown", None: "Unknown"}


def test_outcome_flag_null_is_zero(spark):
    df = spark.createDataFrame([("recovered",), ("relapse",), (None,)], "o string")
    assert [r[0] for r in df.select(outcome_is(F.col("o"), "recovered")).collect()] == [1, 0, 0]


def test_half_up_rounding_money_ties(spark):
    # money_ties: exact half cents round away from zero, like a store into DECIMAL(10,2)
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 2), (1, 3), (2, 3), (10, 0), (None, 1)], "n long, d long")
    got = [r[0] for r in df.select(half_up_div(F.col("n"), F.col("d"))).collect()]
    assert got == [3, -3, 4, 0, 1, None, None]


def test_ratio_money_is_exact_decimal(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (-1, 8)], "n long, d long")
    got = [r[0] for r in df.select(ratio_money(F.col("n"), F.col("d"), 10000)).collect()]
    assert got == [Decimal("33.33"), Decimal("66.67"), Decimal("-12.50")]
    assert df.select(hundredths_to_money(F.lit(12345))).first()[0] == Decimal("123.45")


def test_text_to_int_is_strict(spark):
    assert spark.createDataFrame([(" 9",)], "t string").select(to_int_strict(F.col("t"))).first()[0] == 9
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "t string").select(to_int_strict(F.col("t"))).collect()


def test_conditional_count_and_weighted_sum(spark):
    from healthmart.functions import count_if, weighted_sum
    df = spark.createDataFrame([("a", "recovered", 2, Decimal("1.50")), ("a", None, 3, None), ("a", "died", 1, Decimal("2.00"))],
                               "k string, o string, w long, x decimal(10,2)")
    r = df.groupBy("k").agg(count_if(F.col("o") == "recovered").alias("c"), weighted_sum(F.col("w"), F.col("x")).alias("s")).first()
    assert (r["c"], r["s"]) == (1, Decimal("5.00"))      # NULL outcome counts 0; NULL value is skipped
    empty = df.where("k = 'none'").agg(weighted_sum(F.col("w"), F.col("x")).alias("s")).first()
    assert empty["s"] is None                             # SUM over nothing is NULL, not 0
