"""Registered queries of the jobs that change or maintain stored tables (A8-A11, D4b, D5, C11, stored partials
and bitmaps, layout by person).  Importing this module registers them in ``queries.REGISTRY``.

Each run of a query stores its inputs in a new namespace of its own, below the scratch folder, runs the job on
the stored tables and reads the result back; the SQL states the result over the given tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import oracle as O
from .operators.cascade import cascade, orphan_report
from .operators.checked import checked_append
from .operators.keys import freeze, scratch_namespace
from .operators.scd import scd2_merge
from .plans import audience as AU
from .plans import facts as FT
from .plans import governed as GV
from .plans import kpi
from .plans.incremental import OutcomeFacts, restate_years, store_by_year
from .plans.jobs import store_by_person
from .plans.scenarios import kpis_by_scenario
from .queries import (_DIL, _KPI_SQL, _KPI_SQL_AFTER, _KPI_VIEWS, _MERGED_KPI, _S1, KPI_ACQUIRED, PATIENT, REGISTRY,
                      SCD_CHANGE, TARGET, _dil, _dims, register)
from .plans import warehouse as W
from .session import small_tasks
from .sources.roles import role_views
from .sources.tables import Catalog
from .streaming.arrival import CatalogLookup, run_arrivals_as_of, stream_folder


# -- A11: a person key changes in every table that refers to it ------------------------------------
_MOVE = 1_000_000_000
#: Keys of the stored tables; orders are the one child that the operational schema does not know.
_KEY_GRAPH = [("outcome", "person_id", "diseased_patient", "person_id"), ("outcome", "order_key", "orders", "order_key"),
              ("orders", "person_id", "diseased_patient", "person_id")]
_MOVED_KEY = f"CASE WHEN person_id % 3 = 0 THEN person_id + {_MOVE} ELSE person_id END"


def _cascaded(spark, d) -> Catalog:
    v = role_views(spark, d)
    cat = Catalog(spark, scratch_namespace(spark, "healthmart_cascade"))
    cat.replace_all({"diseased_patient": v.person(), "orders": v.order_person(), "outcome": v.outcome()})
    moved = v.person().where("person_id % 3 = 0").select(F.col("person_id").alias("old_key"), (F.col("person_id") + _MOVE).alias("new_key"))
    cascade(cat, "diseased_patient", "person_id", moved, foreign_keys=_KEY_GRAPH)
    return cat


@register("a11_cascade_outcome", O.with_views(f"SELECT * REPLACE ({_MOVED_KEY} AS person_id) FROM v_outcome", "v_outcome"))
def a11_cascade_outcome(spark, d):
    """The outcomes after every third patient's key has changed in the patient, order and outcome tables."""
    return _cascaded(spark, d).scan("outcome")


@register("a11_cascade_report", O.with_views(f"""
    SELECT t.table_name, COUNT(*) AS n_rows, CAST(SUM(CASE WHEN key > {_MOVE} THEN 1 ELSE 0 END) AS BIGINT) AS moved_rows,
           CAST(SUM(key) AS BIGINT) AS key_sum,
           CASE t.table_name WHEN 'diseased_patient' THEN 0 ELSE
             CAST(SUM(CASE WHEN key NOT IN (SELECT {_MOVED_KEY} FROM v_person) THEN 1 ELSE 0 END) AS BIGINT) END AS orphan_rows
    FROM (SELECT 'diseased_patient' AS table_name, {_MOVED_KEY} AS key FROM v_person
          UNION ALL SELECT 'orders', {_MOVED_KEY} FROM (SELECT o_custkey AS person_id FROM orders) x
          UNION ALL SELECT 'outcome', {_MOVED_KEY} FROM v_outcome) t GROUP BY t.table_name""", "v_outcome", "v_person"))
def a11_cascade_report(spark, d):
    """What the cascade did to each table: rows, rows with a new key, sum of the keys, rows without a patient."""
    cat = _cascaded(spark, d)
    tables = {t: cat.scan(t) for t in ("diseased_patient", "orders", "outcome")}
    key = F.col("person_id")
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(key > _MOVE).alias("moved_rows"), F.sum(key).alias("key_sum"))
             .select(F.lit(t).alias("table_name"), "*") for t, df in tables.items()]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    orphans = orphan_report(tables, _KEY_GRAPH).where("parent_table = 'diseased_patient'").select(F.col("child_table").alias("table_name"), "orphan_rows")
    return out.join(orphans, "table_name", "left").select("table_name", "n_rows", "moved_rows", "key_sum", F.coalesce("orphan_rows", F.lit(0).cast("bigint")).alias("orphan_rows"))


# -- D4b: dated changes, some of them in the past ---------------------------------------------------
#: name, level, start and end year.  In the running version, before the first, at its start, with its own level
#: (no change), two for one name, and a new name.
_SCD_BATCH = [("AUTOMOBILE", 9, 1999, 2005), ("BUILDING", 2, 1990, None), ("FURNITURE", 3, W.SCD_DEFAULT_START, 2010),
              ("HOUSEHOLD", 10, 1997, None), ("MACHINERY", 4, 1998, None), ("MACHINERY", 5, 2000, 2004), ("NEW NAME", 1, 2001, None)]


def _batch_sql() -> str:
    """The same batch by intervals: every change holds from its start to the next start of its name, and what it
    covers of a version is cut away."""
    rows = ", ".join(f"('{n}', CAST({lv} AS BIGINT), CAST({s} AS BIGINT), CAST({e if e is not None else 'NULL'} AS BIGINT))" for n, lv, s, e in _SCD_BATCH)
    return f"""
change AS (SELECT * FROM (VALUES {rows}) c(disease_name, intensity_level, start_year, end_year)),
    real AS (SELECT c.*, d.intensity_level_scd_id AS inside_id, d.start_year AS v_start FROM change c LEFT JOIN d_dil d USING (disease_name)
             WHERE d.intensity_level IS NULL OR c.start_year < d.start_year OR c.intensity_level <> d.intensity_level),
    opened AS (SELECT *, LEAD(start_year) OVER (PARTITION BY disease_name ORDER BY start_year) AS next_start FROM real),
    fresh AS (SELECT disease_name, intensity_level, start_year,
        CASE WHEN v_start > start_year THEN v_start - 1 WHEN next_start IS NOT NULL THEN next_start - 1 ELSE end_year END AS end_year,
        COALESCE(v_start <= start_year, TRUE) AND next_start IS NULL AS is_current FROM opened),
    cut AS (SELECT inside_id, MIN(start_year) AS first_start FROM real WHERE start_year >= v_start GROUP BY inside_id)
    SELECT d.intensity_level_scd_id, d.disease_name, d.intensity_level, d.start_year,
           CASE WHEN cut.first_start IS NULL THEN d.end_year ELSE cut.first_start - 1 END AS end_year, cut.first_start IS NULL AS is_current
    FROM d_dil d LEFT JOIN cut ON cut.inside_id = d.intensity_level_scd_id
    UNION ALL SELECT (SELECT MAX(intensity_level_scd_id) FROM d_dil) + ROW_NUMBER() OVER (ORDER BY disease_name, intensity_level, start_year),
           disease_name, intensity_level, start_year, end_year, is_current FROM fresh"""


@register("d4b_scd_retroactive_batch", O.dims_sql(_batch_sql(), extra=[_DIL]))
def d4b_retroactive(spark, d):
    """One batch of changes with start years before, at and inside the stored versions."""
    dil, _, _ = _dil(role_views(spark, d))
    batch = spark.createDataFrame(_SCD_BATCH, "disease_name string, intensity_level long, start_year long, end_year long")
    return scd2_merge(dil, batch, "disease_name", ["intensity_level"], "intensity_level_scd_id")


# -- A10: the lookup as of arrival -------------------------------------------------------------------
_WAVE = "1998-06-01"


@register("a10_lookup_as_of_arrival", O.with_views(f"""
    SELECT o.*, CASE WHEN o.outcome_date >= DATE '{_WAVE}' THEN i.medicine_id + 1000 ELSE i.medicine_id END AS medicine_id
    FROM v_outcome o LEFT JOIN v_indication i ON o.indication_id = i.indication_id""", "v_outcome", "v_indication"))
def a10_as_of(spark, d):
    """Outcomes arrive in two waves; between them every indication gets another medicine.  Each wave keeps the
    medicines of its own arrival."""
    v = role_views(spark, d)
    cat = Catalog(spark, scratch_namespace(spark, "healthmart_arrival"))
    cat.replace("indication", v.indication())
    arriving, out = stream_folder(spark, "waves"), stream_folder(spark, "as-of")
    outcome = v.outcome()
    lookup = CatalogLookup(cat, "indication", "indication_id")
    first = F.col("outcome_date") < F.lit(_WAVE).cast("date")
    found = None
    for wave in (first, ~first | F.col("outcome_date").isNull()):
        outcome.where(wave).write.mode("append").parquet(arriving)
        found = run_arrivals_as_of(spark, arriving, outcome.schema, lookup, ("indication_id", "indication_id"), ["medicine_id"], out)
        cat.replace("indication", cat.scan("indication").withColumn("medicine_id", F.col("medicine_id") + 1000))
    return found


# -- C11: both scenarios in one job, and C1-C3 from stored bitmaps -------------------------------------
def _both_sql() -> str:
    shape = {"c1": ("NULL", "target_patients", "NULL"), "c2": ("NULL", "other_patients", "NULL"), "c3": ("company_name", "patient_count", "NULL"),
             "c4": ("NULL", "NULL", "target_total_profit"), "c5": ("NULL", "NULL", "other_total_profit"), "c6": ("company_name", "NULL", "total_profit")}
    parts = [f"""SELECT '{name}' AS scenario, '{k}' AS kpi, CAST({c} AS VARCHAR) AS company_name, CAST({n} AS BIGINT) AS patients,
                 CAST({p} AS DECIMAL(38,2)) AS total_profit FROM ({sql[k]}) {k}"""
             for name, sql in (("before", _KPI_SQL), ("after", _KPI_SQL_AFTER)) for k, (c, n, p) in shape.items()]
    return " UNION ALL ".join(parts)


@register("c11_both_scenarios", O.with_views(_both_sql(), *_KPI_VIEWS, extra=_MERGED_KPI))
def c11_both(spark, d):
    """The six KPIs before and after the merger, from one scan of the outcomes."""
    v = role_views(spark, d)
    medicine = v.medicine()
    return kpis_by_scenario(v.outcome(), v.indication(), v.profit(), {"before": medicine, "after": kpi.merge_companies(medicine, TARGET, KPI_ACQUIRED)}, TARGET)


#: First and last month; None: all outcomes.
_PERIODS = {"all": (None, None), "one month": (dt.date(1996, 1, 1), dt.date(1996, 1, 1)), "three years": (dt.date(1997, 1, 1), dt.date(1999, 12, 1))}


def _audience_sql() -> str:
    parts = []
    for period, (first, last) in _PERIODS.items():
        where = "" if first is None else f" WHERE date_trunc('month', outcome_date) BETWEEN DATE '{first}' AND DATE '{last}'"
        for scenario, sql in (("before", _KPI_SQL), ("after", _KPI_SQL_AFTER)):
            for k, c, n in (("c1", "NULL", "target_patients"), ("c2", "NULL", "other_patients"), ("c3", "company_name", "patient_count")):
                body = sql[k].replace("v_outcome", f"(SELECT * FROM v_outcome{where})")
                parts.append(f"SELECT '{period}' AS period, '{scenario}' AS scenario, '{k}' AS kpi, CAST({c} AS VARCHAR) AS company_name, {n} AS patients FROM ({body}) x")
    return " UNION ALL ".join(parts)


@register("c1_c3_from_stored_bitmaps", O.with_views(_audience_sql(), *_KPI_VIEWS, extra=_MERGED_KPI))
def c1_c3_bitmaps(spark, d):
    """Distinct patients of three periods, before and after the merger, all from one stored table of bitmaps."""
    v = role_views(spark, d)
    cat = Catalog(spark, scratch_namespace(spark, "healthmart_bitmaps"))
    stored = cat.replace("patient_bitmaps", AU.patient_bitmaps(v.outcome(), v.medicine(), v.indication()))
    out = None
    for period, (first, last) in _PERIODS.items():
        for scenario, moved in (("before", {}), ("after", {KPI_ACQUIRED: TARGET})):
            part = AU.audience(AU.after_merger(AU.in_months(stored, first, last), moved), TARGET)
            part = part.select(F.lit(period).alias("period"), F.lit(scenario).alias("scenario"), "*")
            out = part if out is None else out.unionByName(part)
    return out


# -- B1, B2 and D5: maintained facts ---------------------------------------------------------------------
_HALF = "1998-06-01"


def _maintained(spark, d):
    """Two batches of outcomes folded one after the other; the second is run twice."""
    v = role_views(spark, d)
    x = _dims(v)
    cells = FT.person_cells(x["person"], x["cond"], x["disease"], x["gender"], x["loc"], x["location"], fixed_domains=True)
    no_country = FT.person_cells(x["person"], x["cond"], x["disease"], x["gender"], fixed_domains=True)
    facts = OutcomeFacts(Catalog(spark, scratch_namespace(spark, "healthmart_maintained")))
    facts.drop()
    early = F.col("outcome_date") < F.lit(_HALF).cast("date")
    # Arrivals are stored once, before they are folded, so line items meet their orders in one join.  A person that
    # the source lists twice has two cells and its lines come twice; one of each, marked, is the outcome itself.
    nth = F.row_number().over(Window.partitionBy("person_id").orderBy(*FT.OUTCOME_KEYS))
    marked = cells.where("person_id IS NOT NULL").withColumn("again", nth > 1)
    with small_tasks(spark):
        lines = freeze(v.outcome_with(marked, how="left", cols=("indication_id", "outcome", "outcome_date")), "arrived")
    outcome = lines.where(~F.coalesce("again", F.lit(False))).select("person_id", "indication_id", "outcome", "outcome_date")
    for batch, rows in (("first", early), ("rest", ~early | F.col("outcome_date").isNull()), ("rest", ~early | F.col("outcome_date").isNull())):
        facts.merge(batch, lines.where(rows), outcome.where(rows), v.indication(), v.profit())
    return facts, v, no_country


@register("b1_fact_from_partials", REGISTRY["b1_fact_disease_outcome"].sql)
def b1_partials(spark, d):
    """B1 from stored (cell, indication) partials of two batches, compacted."""
    facts, v, _ = _maintained(spark, d)
    facts.cells.compact()
    return facts.fact(v.indication(), v.profit())


@register("b2_fact_from_partials", REGISTRY["b2_fact_outcome_no_country"].sql)
def b2_partials(spark, d):
    """B2 from stored (person, cost) partials of two batches."""
    facts, v, cells = _maintained(spark, d)
    return facts.fact_no_country(cells, v.profit())


@register("s1j_fact_restated_by_year", O.dims_sql("SELECT * FROM f_restated", extra=_S1))
def s1j_by_year(spark, d):
    """The intensity fact partitioned by year, with only the changed years rewritten."""
    v = role_views(spark, d)
    dil, d_disease, d_level = _dil(v)
    d_year = freeze(W.dim_year(v.outcome_lines()), "years")
    cat = Catalog(spark, scratch_namespace(spark, "healthmart_by_year"))
    store_by_year(cat, "fact_disease_intensity", FT.fact_disease_intensity(d_year, dil, d_disease, d_level))
    changed = FT.change_intensity(dil, d_disease, *SCD_CHANGE)
    restate_years(cat, "fact_disease_intensity", FT.current_versions_by_year(d_year, changed, d_disease, d_level))
    return cat.scan("fact_disease_intensity")


# -- R2-R6 over tables stored by person ---------------------------------------------------------------------
_BUCKETS = 16


def _by_person(spark, d):
    cat = store_by_person(spark, d, scratch_namespace(spark, "healthmart_by_person"), _BUCKETS)
    return GV.PatientSession(PATIENT), {t: cat.scan(t) for t in ("outcome", "diseased_patient", "indication", "medicine", "location", "disease")}


@register("r3_own_outcomes_by_layout", REGISTRY["r3_own_outcome_rows"].sql)
def r3_layout(spark, d):
    """The patient's outcomes from the one bucket that holds them."""
    ctx, t = _by_person(spark, d)
    return ctx.outcome(t["outcome"])


@register("r6_own_record_by_layout", REGISTRY["r6_patient_own_record"].sql)
def r6_layout(spark, d):
    """The patient's record, opening one bucket of outcomes and one of patients."""
    ctx, t = _by_person(spark, d)
    return GV.my_record(ctx, t["diseased_patient"], t["location"], t["disease"], t["outcome"], t["indication"], t["medicine"])


# -- A8, A9: a checked load ------------------------------------------------------------------------------
#: Lengths that real rows break.
_LIMITS = {"last_name": 18, "first_name": 9, "gender": 1}
_ARRIVED = """SELECT person_id, last_name, first_name, CASE WHEN person_id % 50 = 0 THEN 'XX' ELSE gender END AS gender,
      CASE WHEN person_id % 7 = 0 THEN primary_location_id + 100 ELSE primary_location_id END AS primary_location_id,
      CASE WHEN person_id % 11 = 0 THEN 99 ELSE disease_id END AS disease_id FROM v_person
    UNION ALL SELECT person_id, last_name, first_name, gender, primary_location_id, disease_id FROM v_person WHERE person_id % 13 = 0"""


@register("a8_checked_load", O.with_views(f"""
    arrived AS ({_ARRIVED}), counted AS (SELECT *, COUNT(*) OVER (PARTITION BY person_id) AS copies FROM arrived),
    stored AS (SELECT person_id FROM v_person WHERE person_id % 17 = 0),
    judged AS (SELECT person_id, CONCAT_WS('; ',
        CASE WHEN primary_location_id IS NOT NULL AND primary_location_id NOT IN (SELECT location_id FROM v_location) THEN 'primary_location_id: no such location' END,
        CASE WHEN disease_id IS NOT NULL AND disease_id NOT IN (SELECT disease_id FROM v_condition) THEN 'disease_id: no such disease' END,
        CASE WHEN LENGTH(first_name) > 9 THEN 'first_name: longer than 9' END, CASE WHEN LENGTH(gender) > 1 THEN 'gender: longer than 1' END,
        CASE WHEN LENGTH(last_name) > 18 THEN 'last_name: longer than 18' END,
        CASE WHEN person_id IN (SELECT person_id FROM stored) THEN 'person_id: already stored' END,
        CASE WHEN copies > 1 THEN 'person_id: twice in the batch' END) AS reasons FROM counted)
    SELECT person_id, list_aggregate(list_sort(string_split(reasons, '; ')), 'string_agg', '; ') AS reasons, FALSE AS accepted FROM judged WHERE reasons <> ''
    UNION ALL SELECT person_id, '', TRUE FROM judged WHERE reasons = ''
    UNION ALL SELECT person_id, '', TRUE FROM stored""", "v_person", "v_location", "v_condition"))
def a8_checked(spark, d):
    """Patients loaded into a table that holds some of them already: every arriving row ends up stored or among
    the rejected with its reasons."""
    v = role_views(spark, d)
    cat = Catalog(spark, scratch_namespace(spark, "healthmart_checked"))
    person = v.person().select("person_id", "last_name", "first_name", "gender", "primary_location_id", "disease_id")
    changed = person.withColumn("gender", F.when(F.col("person_id") % 50 == 0, "XX").otherwise(F.col("gender"))) \
        .withColumn("primary_location_id", F.when(F.col("person_id") % 7 == 0, F.col("primary_location_id") + 100).otherwise(F.col("primary_location_id"))) \
        .withColumn("disease_id", F.when(F.col("person_id") % 11 == 0, F.lit(99).cast("bigint")).otherwise(F.col("disease_id")))
    cat.replace_all({"location": v.location(), "disease": v.condition()})
    for t in ("diseased_patient", "diseased_patient__rejected"):
        cat.drop(t)
    checked_append(cat, "diseased_patient", person.where("person_id % 17 = 0"), limits={})
    checked_append(cat, "diseased_patient", changed.unionByName(person.where("person_id % 13 = 0")), limits=_LIMITS)
    stored = cat.scan("diseased_patient").select("person_id", F.lit("").alias("reasons"), F.lit(True).alias("accepted"))
    return cat.scan("diseased_patient__rejected").select("person_id", F.concat_ws("; ", "reasons").alias("reasons"), F.lit(False).alias("accepted")).unionByName(stored)
