"""C11 as one job: the company KPIs C1-C6 under several company assignments (before and after a merger),
from one scan of the outcomes.

Outcomes are counted once into (indication, person) rows.  These meet one small row for each indication: its
company in every scenario and its unit profit.  One exchange by person then carries everything: a person's
companies in a scenario, their profit, and whether the person has an outcome outside the target's
indications are all decided inside that person's partition, and what leaves it are counts and sums that
combine before the last shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kpi import TOTAL

KPIS = "scenario string, kpi string, company_name string, patients bigint, total_profit decimal(38,2)"


def scenario_map(indication: DataFrame, medicines: Mapping[str, DataFrame]) -> DataFrame:
    """``(indication_id, companies)``: for each indication its ``(scenario, known, company)`` under every medicine
    table; ``known`` is false where the indication's medicine does not exist."""
    out = indication.select("indication_id", "medicine_id")
    for i, med in enumerate(medicines.values()):
        m = med.select(F.col("medicine_id").alias(f"_m{i}"), F.col("company").alias(f"_c{i}"))
        out = out.join(m, F.col("medicine_id") == F.col(f"_m{i}"), "left")
    companies = [F.struct(F.lit(name).alias("scenario"), F.col(f"_m{i}").isNotNull().alias("known"), F.col(f"_c{i}").alias("company"))
                 for i, name in enumerate(medicines)]
    return out.select("indication_id", F.array(*companies).alias("companies"))


def kpis_by_scenario(outcome: DataFrame, indication: DataFrame, profit: DataFrame, medicines: Mapping[str, DataFrame],
                     company: str) -> DataFrame:
    """C1-C6 for every scenario, as rows ``(scenario, kpi, company_name, patients, total_profit)``: c1 patients of
    ``company``, c2 patients of an indication not its own, c3 patients per company, c4 its profit, c5 that of
    the other companies, c6 profit per company.  Outcomes without an indication count nowhere."""
    pairs = outcome.where(F.col("indication_id").isNotNull()).groupBy("indication_id", "person_id").agg(F.count(F.lit(1)).alias("n"))
    unit = profit.groupBy("indication_id").agg(F.sum("profit").alias("unit"), F.count(F.lit(1)).alias("margins"))
    side = scenario_map(indication, medicines).join(unit, "indication_id", "left")
    unknown = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(False).alias("known"), F.lit(None).cast("string").alias("company")) for s in medicines])
    rows = pairs.join(side, "indication_id", "left").repartition("person_id") \
        .select("person_id", "n", "unit", F.coalesce("margins", F.lit(0)).alias("margins"), F.explode(F.coalesce("companies", unknown)).alias("c")) \
        .select("person_id", "c.scenario", "c.known", "c.company", "margins", (F.col("n") * F.col("unit")).alias("amount"))
    # Both groupings stay in the person's partition.
    per_company = rows.groupBy("person_id", "scenario", "known", "company").agg(F.sum("amount").alias("amount"), F.sum("margins").alias("margins"))
    own = F.col("known") & F.coalesce(F.col("company") == company, F.lit(False))
    per_person = per_company.groupBy("person_id", "scenario").agg(
        F.collect_list(F.struct("known", "company", "amount", "margins")).alias("companies"), F.max(~own).alias("other"))
    one = F.when(F.col("person_id").isNotNull(), 1).otherwise(0).cast("bigint")
    money = F.lit(None).cast(TOTAL)

    def entry(kpi: str, name, patients, amount):
        return F.struct(F.lit(kpi).alias("kpi"), name.cast("string").alias("company_name"), patients.cast("bigint").alias("patients"),
                        amount.cast(TOTAL).alias("amount"))

    nobody, none = F.lit(None), F.lit(None)

    def entries(c):
        target = F.coalesce(c["company"] == company, F.lit(False))
        rival = F.coalesce(c["company"] != company, F.lit(False))
        return F.filter(F.array(
            F.when(c["known"], entry("c3", c["company"], one, money)), F.when(c["known"] & target, entry("c1", none, one, money)),
            F.when(c["known"] & (c["margins"] > 0), entry("c6", c["company"], nobody, c["amount"])),
            F.when(c["known"] & target, entry("c4", none, nobody, c["amount"])), F.when(c["known"] & rival, entry("c5", none, nobody, c["amount"]))),
            lambda e: e.isNotNull())

    found = F.concat(F.flatten(F.transform("companies", entries)), F.filter(F.array(F.when(F.col("other"), entry("c2", none, one, money))), lambda e: e.isNotNull()))
    parts = per_person.select("scenario", F.explode(found).alias("e")).select("scenario", "e.*")
    # The totals exist also where nothing counts into them.
    zero = [(s, k, None, 0 if k in ("c1", "c2") else None, None) for s in medicines for k in ("c1", "c2", "c4", "c5")]
    parts = parts.unionByName(outcome.sparkSession.createDataFrame(zero, KPIS).withColumnRenamed("total_profit", "amount"))
    return parts.groupBy("scenario", "kpi", "company_name").agg(F.sum("patients").alias("patients"), F.sum("amount").cast(TOTAL).alias("total_profit"))
