"""Fact loads B1-B3, star reads V1-V4 and the SCD-2 change with fact restatement (S1j).

B1 and B2 never build the reference's wide join row by row.  In B1 the outcome rows, with their
patient's fact keys (patient cells), are counted into a written table of (cell, indication) partials;
their sums per indication are its global frequency, and only partials meet the margins.  Partial
aggregation runs map-side, so a hot patient, indication or cell costs one row per map task.
Products of counts and money are computed in 38 digits.  B2's per-person cost table, which the reference joins on the person
alone (k outcomes x c costs rows per person, T7), is folded into per-person sums first; the
result is algebraically identical and linear in size.
"""

from __future__ import annotations

from decimal import Decimal, ROUND_HALF_UP

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import pct_of_rows, weighted_mean
from ..functions.scalar import WIDE, age_bucket, outcome_is, ratio_money
from ..operators.dml import restate, scd2_close
from ..operators.joins import valid_in
from ..operators.keys import freeze, with_dense_id
from ..session import small_tasks
from .warehouse import DISEASE_ATTRS, LOCATION_ATTRS, source_map

OUTCOMES = (("recovered", "recovered_count"), ("worsened", "worsened_count"),
            ("died", "died_count"), ("relapse", "relapsed_count"))
COUNT_COLS = [c for _, c in OUTCOMES]
MEASURES = ["effectiveness", "avg_cost_per_drug", "overall_avg_cost", "avg_profit"]


def overall_avg_cost(profit: DataFrame) -> Column:
    """(SELECT AVG(cost) FROM profit) stored as DECIMAL(10,2): one scalar, computed once."""
    total, n = profit.agg(F.sum("cost_cents"), F.count("cost_cents")).first()
    if not n:
        return F.lit(None).cast("decimal(10,2)")
    q = (Decimal(total) / Decimal(n)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    return F.lit(q / 100).cast("decimal(10,2)")


def person_cells(person: DataFrame, disease: DataFrame, d_disease: DataFrame, d_gender: DataFrame,
                 location: DataFrame | None = None, d_location: DataFrame | None = None,
                 fixed_domains: bool = False) -> DataFrame:
    """person_id -> fact keys as dimension ids: disease and location through their attribute
    tuples, gender through its code, age as the bucket number.  Inner joins, as the reference."""
    # The id maps have one row per source dimension row.  Sources that are fixed domains (their size
    # is checked where they are numbered, or fixed by the schema) are marked for broadcast, so
    # patients are never shuffled onto a handful of keys.
    mark = F.broadcast if fixed_domains else (lambda df: df)
    dmap = mark(source_map(disease, d_disease, DISEASE_ATTRS, "disease_id", "disease_id"))
    p = person.select("person_id", F.col("disease_id").alias("_dsrc"), "gender", "primary_location_id",
                      age_bucket(F.col("age")).alias("age_id"))
    p = p.join(dmap, p._dsrc == dmap.src_id, "inner").withColumnRenamed("dim_id", "disease_id") \
        .drop("src_id", "_dsrc")
    p = p.join(d_gender.select("gender_id", "gender"), "gender", "inner").drop("gender")
    if d_location is not None:
        lmap = mark(source_map(location, d_location, LOCATION_ATTRS, "location_id", "location_id"))
        p = p.join(lmap, p.primary_location_id == lmap.src_id, "inner") \
            .withColumnRenamed("dim_id", "location_id").drop("src_id")
    return p.drop("primary_location_id")


def _flags(outcome: Column) -> list[Column]:
    return [outcome_is(outcome, v) for v, _ in OUTCOMES]


def _finish(agg: DataFrame, keys: list[str], id_name: str, overall: Column) -> DataFrame:
    out = agg.select(
        *keys, *[F.col(c) for c in COUNT_COLS],
        pct_of_rows(F.col("recovered_count"), F.col("_rows")).alias("effectiveness"),
        weighted_mean(F.col("_wsum"), F.col("_wcnt")).alias("avg_cost_per_drug"),
        overall.alias("overall_avg_cost"),
        ratio_money(F.col("_psum"), F.col("_rows")).alias("avg_profit"))
    out = with_dense_id(out, keys, id_name)
    return out.select(id_name, *keys, *COUNT_COLS, *MEASURES)


def fact_disease_outcome(outcome: DataFrame, cells: DataFrame, indication: DataFrame, profit: DataFrame,
                         keys: list[str] | None = None) -> DataFrame:
    """B1: outcome counts and cost/profit measures per (disease, age, gender, location)."""
    lines = outcome.select("person_id", "indication_id", "outcome").join(cells, "person_id", "left")
    return fact_disease_outcome_from_lines(lines, indication, profit, keys)


OUTCOME_KEYS = ["disease_id", "age_id", "gender_id", "location_id"]


def _margins(indication: DataFrame, profit: DataFrame) -> DataFrame:
    return indication.select("indication_id").join(
        profit.select("indication_id", "cost_cents", "profit_cents"), "indication_id", "inner")


def _cell_measures(rows: DataFrame, keys: list[str], n: Column, overall: Column) -> DataFrame:
    """B1 from rows that carry cell, flags or counts, margins, their number ``n`` and the frequency ``_ic``."""
    has_cell = None
    for k in keys:
        c = F.col(k).isNotNull()
        has_cell = c if has_cell is None else has_cell & c
    n, ic = n.cast(WIDE), F.col("_ic").cast(WIDE)
    agg = rows.where(has_cell).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in COUNT_COLS],
        F.sum(n).cast("bigint").alias("_rows"),
        F.sum((n * ic).cast(WIDE) * F.col("cost_cents").cast(WIDE)).alias("_wsum"),
        F.sum((n * ic).cast(WIDE)).alias("_wcnt"),
        F.sum(n * F.col("profit_cents").cast(WIDE)).alias("_psum"))
    return _finish(agg, keys, "fact_disease_outcome_id", overall)


def fact_disease_outcome_from_lines(lines: DataFrame, indication: DataFrame, profit: DataFrame,
                                    keys: list[str] | None = None) -> DataFrame:
    """B1 over outcome rows that already carry their patient's fact keys (NULL keys when the
    patient has no complete cell).  Every outcome row counts towards the *global* frequency of
    its indication (T12); only rows with a cell enter the fact.

    One pass counts outcome rows into (cell, indication) partials, a written table.  Their sums per
    indication are the frequencies, and only partials meet the margins: no second pass over the rows and
    no sort.
    """
    with small_tasks(lines.sparkSession):
        partials = freeze(outcome_partials(lines, keys), "partials")
    return fact_from_partials(partials, indication, profit, keys)


def outcome_partials(lines: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """B1's mergeable state: outcome rows counted per (cell, indication).  Partials of several batches add up."""
    flags = [f.alias(c) for f, (_, c) in zip(_flags(F.col("outcome")), OUTCOMES)]
    keys = keys or OUTCOME_KEYS
    return lines.select(*keys, "indication_id", *flags).groupBy(*keys, "indication_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in COUNT_COLS])


def fact_from_partials(partials: DataFrame, indication: DataFrame, profit: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """B1 from stored partials: frequencies are their sums per indication (T12), measures follow as from the rows."""
    keys = keys or OUTCOME_KEYS
    side = _margins(indication, profit).join(partials.groupBy("indication_id").agg(F.sum("rows").alias("_ic")), "indication_id", "inner")
    # The sums per cell are made here, when the cells are numbered.
    with small_tasks(partials.sparkSession):
        return _cell_measures(partials.join(side, "indication_id", "inner"), keys, F.col("rows"), overall_avg_cost(profit))


def fact_disease_outcome_no_country(outcome: DataFrame, cells: DataFrame, indication: DataFrame,
                                    profit: DataFrame) -> DataFrame:
    """B2, rewritten (T7).  Per person p with main-join outcome rows o and c_p cost rows
    (cost, count) in the reference's Indication_Costs, the fan-out join contributes, per o,
    c_p copies; so every measure is a per-person sum times c_p (or times N_p for the
    cost-table sums) - computed without materialising the product."""
    return fact_from_person_costs(person_costs(outcome, indication, profit), cells, profit)


def person_costs(outcome: DataFrame, indication: DataFrame, profit: DataFrame) -> DataFrame:
    """B2's mergeable state: outcome rows with their margins, summed per (person, cost).  Partials add up."""
    ind = indication.select("indication_id").distinct().withColumn("_has", F.lit(True))
    margins = profit.select("indication_id", "cost_cents", "profit_cents").join(ind, "indication_id", "left")
    flags = [f.alias(c) for f, (_, c) in zip(_flags(F.col("outcome")), OUTCOMES)]
    lines = outcome.select("person_id", "indication_id", *flags).join(margins, "indication_id", "inner")
    has = F.col("_has").isNotNull()
    return lines.groupBy("person_id", "cost_cents").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(has).alias("n"),
        *[F.sum(F.when(has, F.col(c)).otherwise(0)).alias(c) for c in COUNT_COLS],
        F.sum(F.when(has, F.col("profit_cents").cast(WIDE))).alias("p"))


def fact_from_person_costs(pc: DataFrame, cells: DataFrame, profit: DataFrame) -> DataFrame:
    """B2 from the sums per (person, cost)."""
    keys = ["disease_id", "age_id", "gender_id"]
    pp = pc.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("cnt").alias("_s"),
        F.sum(F.col("cost_cents").cast(WIDE) * F.col("cnt").cast(WIDE)).alias("_w"),
        F.sum("n").alias("_n"), *[F.sum(c).alias(c) for c in COUNT_COLS], F.sum("p").alias("_p"))
    pp = pp.where(F.col("_n") > 0)
    j = pp.join(cells, "person_id", "inner")
    agg = j.groupBy(*keys).agg(
        *[F.sum(F.col(c) * F.col("_c")).alias(c) for c in COUNT_COLS],
        F.sum(F.col("_n") * F.col("_c")).alias("_rows"),
        F.sum(F.col("_n").cast(WIDE) * F.col("_w")).alias("_wsum"),
        F.sum(F.col("_n").cast(WIDE) * F.col("_s").cast(WIDE)).alias("_wcnt"),
        F.sum(F.col("_p") * F.col("_c").cast(WIDE)).alias("_psum"))
    return _finish(agg, keys, "fact_disease_outcome_id", overall_avg_cost(profit))


# -- star reads --------------------------------------------------------------------------------

def star_outcome(fact: DataFrame, d_disease: DataFrame, d_age: DataFrame, d_gender: DataFrame,
                 d_location: DataFrame | None = None) -> DataFrame:
    """V1 (with location) / V2 (without): the fact with dimension attributes instead of ids, in the
    stated order, equal rows by fact id."""
    j = fact.join(d_disease.select("disease_id", "disease_name"), "disease_id", "inner") \
        .join(d_age, "age_id", "inner").join(d_gender.select("gender_id", "gender"), "gender_id", "inner")
    geo = []
    if d_location is not None:
        j = j.join(d_location.select("location_id", "country_name"), "location_id", "inner")
        geo = ["country_name"]
    out = j.select("fact_disease_outcome_id", "disease_name", "age_range", "gender", *geo, *COUNT_COLS, *MEASURES)
    if d_location is not None:
        return out.orderBy(F.col("effectiveness").desc_nulls_first(), F.col("avg_cost_per_drug").desc_nulls_first(),
                           "fact_disease_outcome_id")
    return out.orderBy(F.col("effectiveness").asc_nulls_last(), F.col("avg_cost_per_drug").desc_nulls_first(),
                       "fact_disease_outcome_id")


# -- SCD-2 intensity fact --------------------------------------------------------------------

def current_versions_by_year(d_year: DataFrame, dil: DataFrame, d_disease: DataFrame,
                             d_level: DataFrame) -> DataFrame:
    """(year_id, year, disease_id, intensity_level_id) for every year inside a current version;
    the level id is NULL when the version's level has no dimension row."""
    cur = dil.where(F.col("is_current")).select("disease_name", "intensity_level", "start_year", "end_year")
    yv = valid_in(d_year, cur)
    j = yv.join(d_disease.select("disease_id", F.col("disease_name").alias("_dn")),
                yv.disease_name == F.col("_dn"), "inner")
    j = j.join(d_level.select("intensity_level_id", F.col("intensity_level").alias("_lv")),
               j.intensity_level == F.col("_lv"), "left")
    return j.select("year_id", "year", "disease_id", "intensity_level_id", "intensity_level")


def fact_disease_intensity(d_year: DataFrame, dil: DataFrame, d_disease: DataFrame, d_level: DataFrame) -> DataFrame:
    """One row per (year, disease) covered by a current version, ids ordered by (year, disease)."""
    v = current_versions_by_year(d_year, dil, d_disease, d_level).where(F.col("intensity_level_id").isNotNull())
    v = with_dense_id(v, ["year", "disease_id"], "fact_disease_intensity_id")
    return v.select("fact_disease_intensity_id", "year_id", "disease_id", "intensity_level_id")


def star_intensity(fact: DataFrame, d_year: DataFrame, d_disease: DataFrame, d_level: DataFrame,
                   years: tuple[int, ...] | None = None) -> DataFrame:
    """V3 / V4 (``years`` given): the intensity fact with year, disease name and level."""
    y = d_year if years is None else d_year.where(F.col("year").isin(*years))
    j = fact.join(y, "year_id", "inner").join(d_disease.select("disease_id", "disease_name"), "disease_id", "inner") \
        .join(d_level, "intensity_level_id", "inner")
    return j.select("fact_disease_intensity_id", "year", "disease_name", "intensity_level") \
        .orderBy(F.col("year").asc_nulls_last(), F.col("disease_name").asc_nulls_last())


def change_intensity(dil: DataFrame, d_disease: DataFrame, disease_name: str, level: str,
                     from_year: int, to_year: int | None) -> DataFrame:
    """S1j, first half: close the current version of one disease at ``from_year - 1`` (D3) and
    open ``level`` from ``from_year`` (D4).  The level arrives as text, as in the reference's
    literal insert, and is cast to the column type."""
    keys = d_disease.where(F.col("disease_name") == disease_name).select("disease_name")
    closed = scd2_close(dil, keys, "disease_name", from_year - 1)
    # One literal row: its id is the next one, without the key builder.
    top = dil.agg(F.max("intensity_level_scd_id")).first()[0] or 0
    row = dil.sparkSession.createDataFrame([(top + 1, disease_name, level, from_year, to_year, True)],
                                           "intensity_level_scd_id long, disease_name string, intensity_level string, start_year long, end_year long, is_current boolean")
    return closed.unionByName(row.select(*[F.col(c).cast(dil.schema[c].dataType) for c in dil.columns]))


def restate_intensity(fact: DataFrame, d_year: DataFrame, dil: DataFrame, d_disease: DataFrame,
                      d_level: DataFrame) -> DataFrame:
    """S1j, second half (D5): re-point every fact row covered by a current version."""
    v = current_versions_by_year(d_year, dil, d_disease, d_level)
    return restate(fact, v, ["year_id", "disease_id"], "intensity_level_id", "intensity_level_id")
