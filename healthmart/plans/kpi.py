"""Company KPIs (C1-C6), competing products (C7, C8), the merger (C9, C10) and the KPI
before/after comparison (C11).

Plan shape: the medicine/indication side (one row per indication) is filtered first; the
outcome side is only ever semi-joined, counted per indication (partial aggregation map-side)
and then joined to the margins - the aggregate-before-join rewrite of the reference, which
keeps the shuffle at one row per (map task, indication) whatever the number of outcomes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import weighted_sum
from ..operators.dml import update_from, update_where
from ..operators.joins import freq, not_in, semi

TOTAL = "decimal(38,2)"


def company_indications(medicine: DataFrame, indication: DataFrame) -> DataFrame:
    """(indication_id, company) - the Company_Indications CTE."""
    m = medicine.select("medicine_id", "company")
    return indication.select("indication_id", "medicine_id").join(m, "medicine_id", "inner") \
        .select("indication_id", "company")


def target_indications(medicine: DataFrame, indication: DataFrame, company: str, *,
                       negate: bool = False) -> DataFrame:
    """Indications of drugs sold by ``company`` (or, ``negate``, by any other non-NULL company)."""
    pick = F.col("company") != company if negate else F.col("company") == company
    meds = medicine.where(pick).select("medicine_id")
    return semi(indication.select("indication_id", "medicine_id"), meds, "medicine_id").select("indication_id")


def c1_patients(outcome: DataFrame, medicine: DataFrame, indication: DataFrame, company: str) -> DataFrame:
    """Distinct patients treated with the company's drugs (exact count)."""
    # Distinct pairs first: only they are shuffled to meet the company's indications.
    hit = semi(outcome.select("person_id", "indication_id").distinct(),
               target_indications(medicine, indication, company), "indication_id")
    return hit.agg(F.countDistinct("person_id").alias("target_patients"))


def c2_other_patients(outcome: DataFrame, medicine: DataFrame, indication: DataFrame,
                      company: str) -> DataFrame:
    """Distinct patients with an outcome on an indication *not in* the company's set
    (NOT IN semantics, T4).  Not the complement of C1."""
    rest = not_in(outcome.select("person_id", "indication_id").distinct(),
                  target_indications(medicine, indication, company), "indication_id")
    return rest.agg(F.countDistinct("person_id").alias("other_patients"))


def c3_patients_per_company(outcome: DataFrame, medicine: DataFrame, indication: DataFrame) -> DataFrame:
    """Distinct patients per company, largest first (NULLs first when descending, as PostgreSQL),
    equal ones by name."""
    # Distinct (indication, person) pairs first, so only they are shuffled to meet the companies.
    pairs = outcome.select("person_id", "indication_id").distinct()
    j = pairs.join(company_indications(medicine, indication), "indication_id", "inner")
    return j.groupBy(F.col("company").alias("company_name")).agg(
        F.countDistinct("person_id").alias("patient_count")).orderBy(F.col("patient_count").desc_nulls_first(), F.col("company_name").asc_nulls_last())


def _profit_total(counts: DataFrame, profit: DataFrame, keys: list[str], name: str) -> DataFrame:
    p = profit.select("indication_id", "profit")
    j = counts.join(p, "indication_id", "inner")
    total = weighted_sum(F.col("occurrence_count"), F.col("profit")).cast(TOTAL).alias(name)
    return j.groupBy(*keys).agg(total) if keys else j.agg(total)


def c4_profit(outcome: DataFrame, medicine: DataFrame, indication: DataFrame, profit: DataFrame,
              company: str) -> DataFrame:
    """C4: company total profit = sum over indications of (outcome count x unit profit)."""
    counts = freq(outcome.select("indication_id"), ["indication_id"])
    hit = semi(counts, target_indications(medicine, indication, company), "indication_id")
    return _profit_total(hit, profit, [], "target_total_profit")


def c5_other_profit(outcome: DataFrame, medicine: DataFrame, indication: DataFrame, profit: DataFrame,
                    company: str) -> DataFrame:
    """As C4 for every other company; ``!=`` drops drugs with a NULL company (T5)."""
    counts = freq(outcome.select("indication_id"), ["indication_id"])
    hit = semi(counts, target_indications(medicine, indication, company, negate=True), "indication_id")
    return _profit_total(hit, profit, [], "other_total_profit")


def c6_profit_per_company(outcome: DataFrame, medicine: DataFrame, indication: DataFrame,
                          profit: DataFrame) -> DataFrame:
    """Profit per company, largest first, equal ones by name."""
    # Count per indication before attaching the company: the outcome side shrinks to one row per
    # indication before any join, and each indication has exactly one company.
    counts = freq(outcome.select("indication_id"), ["indication_id"])
    counts = counts.join(company_indications(medicine, indication), "indication_id", "inner")
    out = _profit_total(counts, profit, ["company"], "total_profit")
    return out.select(F.col("company").alias("company_name"), "total_profit") \
        .orderBy(F.col("total_profit").desc_nulls_first(), F.col("company_name").asc_nulls_last())


# -- competing products and the merger -------------------------------------------------------

def competing_products(medicine: DataFrame, companies: tuple[str, str]) -> DataFrame:
    """Drugs of the two companies whose active ingredient occurs more than once among them
    (two drugs of the same company also count, as written in the reference), by ingredient and drug."""
    two = medicine.where(F.col("company").isin(*companies))
    dup = two.groupBy("active_ingredient_name").count().where(F.col("count") > 1)
    return semi(two, dup, "active_ingredient_name").orderBy(F.col("active_ingredient_name").asc_nulls_last(), "medicine_id")


def competing_outcomes(outcome: DataFrame, indication: DataFrame, medicine: DataFrame,
                       companies: tuple[str, str], n: int = 20) -> DataFrame:
    """A sample of ``n`` outcomes on competing products.  The reference takes any 20 rows;
    we order by every output column first so the sample is reproducible."""
    meds = competing_products(medicine, companies).select(
        "medicine_id", F.col("name").alias("medication_name"), "company")
    j = outcome.select("order_key", "line_number", "person_id", "indication_id", "outcome", "outcome_date") \
        .join(indication.select("indication_id", "medicine_id"), "indication_id", "inner") \
        .join(meds, "medicine_id", "inner")
    cols = ["order_key", "line_number", "person_id", "indication_id", "outcome", "outcome_date",
            "medication_name", "company"]
    return j.select(*cols).orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(n)


def merger_rename(medicine: DataFrame, acquirer: str, acquired: str) -> DataFrame:
    """The acquired company's drugs take the acquirer's name for the same ingredient.

    The acquirer may sell several names per ingredient; PostgreSQL's UPDATE ... FROM would pick
    one arbitrarily, we pick the smallest name so the result is deterministic.
    """
    names = medicine.where(F.col("company") == acquirer).groupBy("active_ingredient_name") \
        .agg(F.min("name").alias("acquirer_name"))
    return update_from(medicine, names, "active_ingredient_name", {"name": "acquirer_name"},
                       cond=F.col("company") == acquired)


def merger_move(medicine: DataFrame, acquirer: str, acquired: str) -> DataFrame:
    """Move every drug of the acquired company to the acquirer."""
    return update_where(medicine, F.col("company") == acquired, {"company": acquirer})


def merge_companies(medicine: DataFrame, acquirer: str, acquired: str) -> DataFrame:
    return merger_move(merger_rename(medicine, acquirer, acquired), acquirer, acquired)
