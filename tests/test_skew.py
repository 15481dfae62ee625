"""Hot keys: a third of all orders on one customer and a third of all line items on one
supplier.  The jobs must give the oracle's answer on such data (AQE may split the hot
partitions, partial aggregation collapses them; nothing may drop or cap rows)."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from healthmart.operators import keys
from healthmart.operators.keys import scratch_path
from healthmart.plans import facts as FT

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
HOT_JOBS = ["c1_target_patients", "c2_other_patients", "c3_patients_per_company", "c6_profit_per_company",
            "b1_fact_disease_outcome", "b2_fact_outcome_no_country", "r1_medical_records_doctor",
            "r6_patient_own_record", "m9_dim_diseased_patient", "a2_load_outcome_table"]


@pytest.fixture(scope="module")
def skewed(spark):
    root = scratch_path(spark, "skewed-tables")
    for t in TABLES:
        df = spark.read.parquet(f"{SF001}/{t}.parquet")
        if t == "orders":
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")))
        if t == "lineitem":
            df = df.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 1, F.lit(2)).otherwise(F.col("l_suppkey")))
        df.write.parquet(f"{root}/{t}.parquet")
    con = duckdb.connect()
    local = root.replace("file:", "")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{local}/{t}.parquet/*.parquet')")
    return root, con


def _nullsafe(t):
    return tuple((x is None, str(x)) for x in t)


@pytest.mark.parametrize("name", HOT_JOBS)
def test_hot_keys_match_oracle(spark, skewed, name):
    root, con = skewed
    df = E.queries()[name](spark, root)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=_nullsafe)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=_nullsafe)
    assert got == want


def test_a_task_of_the_outcome_fact_does_not_take_a_growing_share(spark, monkeypatch):
    """Few shuffle partitions do not decide how many rows a task sorts and counts; the settings come back."""
    frozen = []
    monkeypatch.setattr(FT, "freeze", lambda df, tag: frozen.append(keys.freeze(df, tag)) or frozen[-1])
    n = 500_000
    lines = spark.range(n).selectExpr("id % 7 AS disease_id", "id % 8 AS age_id", "id % 3 AS gender_id", "id % 25 AS location_id",
                                      "pmod(xxhash64(id), 100000) AS indication_id", "'died' AS outcome")
    supplier = spark.range(100_000).selectExpr("id AS indication_id", "id AS cost_cents", "id AS profit_cents")
    settings = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(k, None) for k in settings]
    spark.conf.set(settings[0], "2")
    try:
        fact = FT.fact_disease_outcome_from_lines(lines, supplier, supplier)
        assert spark.conf.get(settings[1], None) == before[1] and spark.conf.get(settings[2], None) == before[2]
    finally:
        spark.conf.set(settings[0], before[0])
    assert len(frozen[0].inputFiles()) > 2
    assert fact.agg(F.sum("died_count")).first()[0] == n
