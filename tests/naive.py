"""B2 as the reference joins it, for comparison in tests and in the benchmark."""

from pyspark.sql import functions as F

from healthmart.functions.aggregates import count_if
from healthmart.plans.facts import OUTCOMES, _finish, overall_avg_cost


def fact_disease_outcome_no_country_naive(outcome, cells, indication, profit):
    """B2 exactly as the reference joins it (fan-out on person).  Comparison and tests only:
    its intermediate size is sum over persons of outcomes x distinct costs."""
    keys = ["disease_id", "age_id", "gender_id"]
    o = outcome.select("person_id", "indication_id", "outcome")
    pr = profit.select("indication_id", "cost_cents", "profit_cents")
    ic = o.join(pr, "indication_id", "inner").groupBy("person_id", F.col("cost_cents").alias("_ic_cost")) \
        .agg(F.count("indication_id").alias("_ic_n"))
    j = cells.join(o, "person_id", "inner").join(indication.select("indication_id"), "indication_id", "inner") \
        .join(pr, "indication_id", "inner").join(ic, "person_id", "inner")
    agg = j.groupBy(*keys).agg(
        *[count_if(F.col("outcome") == v).alias(c) for v, c in OUTCOMES],
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("_ic_cost") * F.col("_ic_n")).alias("_wsum"),
        F.sum("_ic_n").alias("_wcnt"),
        F.sum("profit_cents").alias("_psum"))
    return _finish(agg, keys, "fact_disease_outcome_id", overall_avg_cost(profit))
