"""Registry of the product queries over the test tables: name -> (Spark builder, oracle SQL).

Parameters are the re-aimed values of the reference's literals: the target company is the
region ``ASIA`` (KPI medicine view); the two competing companies are the brands ``Brand#1``
(acquirer) and ``Brand#2`` (acquired) of the part medicine view.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions.scalar import to_int_strict
from .operators import integrity as IG
from .operators.cascade import orphan_report
from .operators.dml import remap_key, scd2_apply
from .operators.keys import CONDITIONS, LOCATIONS, freeze, scratch_namespace, with_dense_id
from .plans import facts as FT
from .plans import governed as GV
from .plans import kpi
from .plans import warehouse as W
from .plans.jobs import apply_intensity_change
from .sources.roles import role_views
from .sources.schemas import SCHEMAS
from .sources.tables import Catalog, append_rows, conform
from .streaming.arrival import enrich_on_arrival, run_arrivals

TARGET = "ASIA"
KPI_ACQUIRED = "AMERICA"
COMPETING = ("Brand#1", "Brand#2")


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


# -- C1-C6 and C11 ---------------------------------------------------------------------------
_KPI_VIEWS = ("v_outcome", "v_indication", "v_profit", "v_medicine")
_KPI_SQL = O.kpi_sql(TARGET)
_KPI_SQL_AFTER = O.kpi_sql(TARGET, "v_medicine_merged")
_MERGED_KPI = O.merged_medicine_sql("v_medicine", TARGET, KPI_ACQUIRED)


def _kpi_sql(key: str, after: bool) -> str:
    if not after:
        return O.with_views(_KPI_SQL[key], *_KPI_VIEWS)
    return O.with_views(_KPI_SQL_AFTER[key], *_KPI_VIEWS, extra=_MERGED_KPI)


_KPI_FN = {
    "c1": lambda o, m, i, p: kpi.c1_patients(o, m, i, TARGET),
    "c2": lambda o, m, i, p: kpi.c2_other_patients(o, m, i, TARGET),
    "c3": lambda o, m, i, p: kpi.c3_patients_per_company(o, m, i),
    "c4": lambda o, m, i, p: kpi.c4_profit(o, m, i, p, TARGET),
    "c5": lambda o, m, i, p: kpi.c5_other_profit(o, m, i, p, TARGET),
    "c6": lambda o, m, i, p: kpi.c6_profit_per_company(o, m, i, p),
}


def _kpi(spark: SparkSession, sf_dir: str, key: str, after: bool) -> DataFrame:
    v = role_views(spark, sf_dir)
    med = v.medicine()
    if after:
        med = kpi.merge_companies(med, TARGET, KPI_ACQUIRED)
    return _KPI_FN[key](v.outcome(), med, v.indication(), v.profit())


for _after, _prefix in ((False, ""), (True, "c11_after_merger_")):
    for _key, _name in (("c1", "c1_target_patients"), ("c2", "c2_other_patients"),
                        ("c3", "c3_patients_per_company"), ("c4", "c4_target_profit"),
                        ("c5", "c5_other_profit"), ("c6", "c6_profit_per_company")):
        _qname = (_prefix + _name[3:]) if _after else _name
        register(_qname, _kpi_sql(_key, _after))(
            lambda spark, sf_dir, a=_after, k=_key: _kpi(spark, sf_dir, k, a))


# -- C7-C10 ----------------------------------------------------------------------------------
_COMP_IN = f"('{COMPETING[0]}', '{COMPETING[1]}')"


def _competing_sql(src: str) -> str:
    """Drugs of the two companies whose ingredient is shared by more than one of their drugs."""
    return f"""SELECT medicine_id, standard_industry_number, name, company, active_ingredient_name
        FROM (SELECT *, COUNT(*) OVER (PARTITION BY active_ingredient_name) AS sharing
              FROM {src} WHERE company IN {_COMP_IN}) t
        WHERE sharing > 1 AND active_ingredient_name IS NOT NULL"""


@register("c7_competing_products", O.with_views(_competing_sql("v_medicine_part"), "v_medicine_part"))
def c7(spark, sf_dir):
    return kpi.competing_products(role_views(spark, sf_dir).medicine_part(), COMPETING)


def _competing_outcomes_sql(src: str) -> str:
    return f"""
    SELECT o.order_key, o.line_number, o.person_id, o.indication_id, o.outcome, o.outcome_date,
           cp.name AS medication_name, cp.company
    FROM ({_competing_sql(src)}) cp
    JOIN v_indication_part i ON i.medicine_id = cp.medicine_id
    JOIN v_outcome_part o ON o.indication_id = i.indication_id
    ORDER BY 1, 2, 3, 4, 5, 6, 7, 8 LIMIT 20"""


_COMP_VIEWS = ("v_outcome_part", "v_indication_part", "v_medicine_part")


@register("c8_competing_outcomes", O.with_views(_competing_outcomes_sql("v_medicine_part"), *_COMP_VIEWS))
def c8(spark, sf_dir):
    v = role_views(spark, sf_dir)
    return kpi.competing_outcomes(v.outcome_part(), v.indication_part(), v.medicine_part(), COMPETING)


_MERGED_PART = O.merged_medicine_sql("v_medicine_part", *COMPETING)


@register("c9_merger_rename", O.with_views("SELECT * FROM v_medicine_part_renamed", "v_medicine_part",
                                           extra=_MERGED_PART[:2]))
def c9(spark, sf_dir):
    return kpi.merger_rename(role_views(spark, sf_dir).medicine_part(), *COMPETING)


@register("c10_merger_move", O.with_views("SELECT * FROM v_medicine_part_merged", "v_medicine_part",
                                          extra=_MERGED_PART))
def c10(spark, sf_dir):
    return kpi.merge_companies(role_views(spark, sf_dir).medicine_part(), *COMPETING)


@register("c7_after_rename_competing_products", O.with_views(_competing_sql("v_medicine_part_renamed"),
                                                            "v_medicine_part", extra=_MERGED_PART[:2]))
def c7_renamed(spark, sf_dir):
    """The confirm read between the rename and the move."""
    return kpi.competing_products(kpi.merger_rename(role_views(spark, sf_dir).medicine_part(), *COMPETING), COMPETING)


@register("c8_after_merger_competing_outcomes", O.with_views(_competing_outcomes_sql("v_medicine_part_merged"),
                                                            *_COMP_VIEWS, extra=_MERGED_PART))
def c8_after(spark, sf_dir):
    v = role_views(spark, sf_dir)
    return kpi.competing_outcomes(v.outcome_part(), v.indication_part(), kpi.merge_companies(v.medicine_part(), *COMPETING), COMPETING)


@register("c7_after_merger_competing_products", O.with_views(_competing_sql("v_medicine_part_merged"),
                                                            "v_medicine_part", extra=_MERGED_PART))
def c7_after(spark, sf_dir):
    merged = kpi.merge_companies(role_views(spark, sf_dir).medicine_part(), *COMPETING)
    return kpi.competing_products(merged, COMPETING)


# -- warehouse: dimensions M1-M11 --------------------------------------------------------------

SCD_CHANGE = ("AUTOMOBILE", "9", 2001, W.SCD_DEFAULT_END)  # re-aim of the reference's change
V4_YEARS = (2000, 2001)


class _Dims:
    """Dimensions of one query, built on first use only."""

    def __init__(self, v):
        self.v = v
        self._c = {}

    def __getitem__(self, key):
        if key not in self._c:
            v = self.v
            make = {"person": v.person, "cond": v.condition, "loc": v.location,
                    "age": lambda: W.dim_age(self["person"]),
                    "disease": lambda: W.dim_disease(self["cond"], at_most=CONDITIONS),
                    "gender": lambda: W.dim_gender(self["person"]),
                    "location": lambda: W.dim_location(self["loc"], at_most=LOCATIONS)}
            self._c[key] = make[key]()
        return self._c[key]


def _dims(v):
    return _Dims(v)


register("m1_dim_age", O.dims_sql("SELECT * FROM d_age"))(
    lambda spark, d: W.dim_age(role_views(spark, d).person()))
register("m2_dim_disease", O.dims_sql("SELECT * FROM d_disease"))(
    lambda spark, d: W.dim_disease(role_views(spark, d).condition()))
register("m3_dim_medicine", O.with_views(
    f"""SELECT {O.rn('src')} AS medicine_id, medicine_name, company FROM
        (SELECT name AS medicine_name, company, MIN(medicine_id) AS src FROM v_medicine_part_merged
         GROUP BY name, company) t""", "v_medicine_part", extra=_MERGED_PART))(
    lambda spark, d: W.dim_medicine(kpi.merge_companies(role_views(spark, d).medicine_part(), *COMPETING)))


@register("m4_dim_indication", O.with_views(
    f"""SELECT i.indication_id, dm.medicine_id, i.disease_id FROM v_indication i
        JOIN (SELECT m.medicine_id AS src_id, dm.medicine_id FROM v_medicine_merged m
                   JOIN dmk dm ON m.name IS NOT DISTINCT FROM dm.medicine_name
                              AND m.company IS NOT DISTINCT FROM dm.company) dm ON i.medicine_id = dm.src_id""",
    "v_indication", "v_medicine", extra=_MERGED_KPI + [("dmk", f"""SELECT {O.rn('src')} AS medicine_id, medicine_name, company
        FROM (SELECT name AS medicine_name, company, MIN(medicine_id) AS src FROM v_medicine_merged
              GROUP BY name, company) t""")]))
def m4(spark, d):
    v = role_views(spark, d)
    med = kpi.merge_companies(v.medicine(), TARGET, KPI_ACQUIRED)
    return W.dim_indication(v.indication(), med, W.dim_medicine(med))


@register("m4_dim_indication_literal", O.with_views(f"""
    SELECT DISTINCT i.indication_id, i.medicine_id, i.disease_id FROM v_indication i WHERE i.medicine_id IN (SELECT medicine_id FROM dmk)""",
    "v_indication", "v_medicine", extra=_MERGED_KPI + [("dmk", f"""SELECT {O.rn('src')} AS medicine_id, medicine_name, company
        FROM (SELECT name AS medicine_name, company, MIN(medicine_id) AS src FROM v_medicine_merged
              GROUP BY name, company) t""")]))
def m4_literal(spark, d):
    """As the reference writes it: by the source medicine id itself."""
    v = role_views(spark, d)
    med = kpi.merge_companies(v.medicine(), TARGET, KPI_ACQUIRED)
    return W.dim_indication(v.indication(), med, W.dim_medicine(med), literal=True)


register("m5_dim_gender", O.dims_sql("SELECT * FROM d_gender"))(
    lambda spark, d: W.dim_gender(role_views(spark, d).person()))
register("m6_dim_location", O.dims_sql("SELECT * FROM d_location"))(
    lambda spark, d: W.dim_location(role_views(spark, d).location()))
register("m7_dim_profit", O.dims_sql("SELECT * FROM d_profit"))(
    lambda spark, d: W.dim_profit(role_views(spark, d).profit()))
register("m8_dim_year", O.dims_sql("SELECT * FROM d_year"))(
    lambda spark, d: W.dim_year(role_views(spark, d).outcome_lines()))


@register("m9_dim_diseased_patient", O.dims_sql(f"""
    SELECT {O.rn('pe.person_id')} AS diseased_patient_id, pe.last_name, pe.first_name, g.gender_id, a.age_id,
           pe.is_insured, pe.start_date, pe.end_date, pe.person_id
    FROM v_person_d pe LEFT JOIN d_gender g ON g.gender = pe.gender
    LEFT JOIN d_age a ON a.age_range = {O.age_range('pe.age')}""", "v_person_d"))
def m9(spark, d):
    v = role_views(spark, d)
    person = v.person(with_dates=True)
    return W.dim_diseased_patient(person, W.dim_gender(person), W.dim_age(person))


register("m10_dim_intensity_level", O.dims_sql("SELECT * FROM d_level"))(
    lambda spark, d: W.dim_intensity_level(role_views(spark, d).condition()))

_DIL = O.dil_sql(W.SCD_DEFAULT_START, W.SCD_DEFAULT_END)


def _dil(v):
    cond = v.condition()
    d_disease = W.dim_disease(cond, at_most=CONDITIONS)
    d_level = W.dim_intensity_level(cond, at_most=CONDITIONS)
    return W.dim_disease_intensity(cond, d_disease, d_level, at_most=CONDITIONS), d_disease, d_level


register("m11_dim_disease_intensity", O.dims_sql("SELECT * FROM d_dil", extra=[_DIL]))(
    lambda spark, d: _dil(role_views(spark, d))[0])


# -- facts, star reads, SCD change -------------------------------------------------------------
_F1 = O.outcome_fact_sql(True)
_F2 = O.outcome_fact_sql(False)


def _outcome_fact(spark, d, with_location: bool):
    v = role_views(spark, d)
    x = _dims(v)
    if with_location:
        cells = FT.person_cells(x["person"], x["cond"], x["disease"], x["gender"], x["loc"], x["location"],
                                fixed_domains=True)
        lines = v.outcome_with(cells, how="left", cols=("indication_id", "outcome"))
        fact = FT.fact_disease_outcome_from_lines(lines, v.indication(), v.profit())
    else:
        cells = FT.person_cells(x["person"], x["cond"], x["disease"], x["gender"], fixed_domains=True)
        fact = FT.fact_disease_outcome_no_country(v.outcome(), cells, v.indication(), v.profit())
    return fact, x


register("b1_fact_disease_outcome", O.dims_sql("SELECT * FROM f_outcome", "v_indication", extra=_F1))(
    lambda spark, d: _outcome_fact(spark, d, True)[0])
register("b2_fact_outcome_no_country", O.dims_sql("SELECT * FROM f_outcome_nc", "v_indication", extra=_F2))(
    lambda spark, d: _outcome_fact(spark, d, False)[0])

_V_COLS = """recovered_count, worsened_count, died_count, relapsed_count, effectiveness, avg_cost_per_drug,
             overall_avg_cost, avg_profit"""


@register("v1_star_outcome", O.dims_sql(f"""
    SELECT f.fact_disease_outcome_id, d.disease_name, a.age_range, g.gender, l.country_name, {_V_COLS}
    FROM f_outcome f JOIN d_disease d ON f.disease_id = d.disease_id JOIN d_age a ON f.age_id = a.age_id
    JOIN d_gender g ON f.gender_id = g.gender_id JOIN d_location l ON f.location_id = l.location_id
    ORDER BY f.effectiveness DESC, f.avg_cost_per_drug DESC""", "v_indication", extra=_F1))
def v1(spark, d):
    fact, x = _outcome_fact(spark, d, True)
    return FT.star_outcome(fact, x["disease"], x["age"], x["gender"], x["location"])


@register("v2_star_outcome_no_country", O.dims_sql(f"""
    SELECT f.fact_disease_outcome_id, d.disease_name, a.age_range, g.gender, {_V_COLS}
    FROM f_outcome_nc f JOIN d_disease d ON f.disease_id = d.disease_id JOIN d_age a ON f.age_id = a.age_id
    JOIN d_gender g ON f.gender_id = g.gender_id
    ORDER BY effectiveness, avg_cost_per_drug DESC""", "v_indication", extra=_F2))
def v2(spark, d):
    fact, x = _outcome_fact(spark, d, False)
    return FT.star_outcome(fact, x["disease"], x["age"], x["gender"])


def _intensity(spark, d, changed: bool):
    v = role_views(spark, d)
    dil, d_disease, d_level = _dil(v)
    d_year = freeze(W.dim_year(v.outcome_lines()), "years")   # read several times; the line items only once
    fact = FT.fact_disease_intensity(d_year, dil, d_disease, d_level)
    if changed:
        dil = FT.change_intensity(dil, d_disease, *SCD_CHANGE)
        fact = FT.restate_intensity(fact, d_year, dil, d_disease, d_level)
    return fact, dil, d_year, d_disease, d_level


_B3 = [_DIL, O.intensity_fact_sql("d_dil")]
_S1 = _B3 + [O.dil_changed_sql(*SCD_CHANGE), O.restated_sql("f_int", "d_dil2")]
_V3 = """SELECT f.fact_disease_intensity_id, y.year AS year, d.disease_name, ilq.intensity_level AS intensity_level
    FROM {f} f JOIN d_year y ON f.year_id = y.year_id JOIN d_disease d ON f.disease_id = d.disease_id
    JOIN d_level ilq ON f.intensity_level_id = ilq.intensity_level_id {where} ORDER BY y.year, d.disease_name"""

register("b3_fact_disease_intensity", O.dims_sql("SELECT * FROM f_int", extra=_B3))(
    lambda spark, d: _intensity(spark, d, False)[0])


@register("v3_star_intensity", O.dims_sql(_V3.format(f="f_int", where=""), extra=_B3))
def v3(spark, d):
    fact, _, d_year, d_disease, d_level = _intensity(spark, d, False)
    return FT.star_intensity(fact, d_year, d_disease, d_level)


register("s1j_dim_after_change", O.dims_sql("SELECT * FROM d_dil2", extra=_S1))(
    lambda spark, d: _intensity(spark, d, True)[1])
register("s1j_fact_restated", O.dims_sql("SELECT * FROM f_restated", extra=_S1))(
    lambda spark, d: _intensity(spark, d, True)[0])


@register("v4_star_intensity_two_years", O.dims_sql(
    _V3.format(f="f_restated", where=f"WHERE y.year IN {V4_YEARS}"), extra=_S1))
def v4(spark, d):
    fact, _, d_year, d_disease, d_level = _intensity(spark, d, True)
    return FT.star_intensity(fact, d_year, d_disease, d_level, years=V4_YEARS)


# -- governed reads R1-R6 ------------------------------------------------------------------------

PATIENT = 1  # the reference reads as patient 1
_REC = """pe.last_name, pe.first_name, pe.gender, pe.age, loc.country_name, pe.is_insured, cd.disease_name AS disease,
          drug.name AS medication_name, pe.severity_value, pe.start_date, pe.end_date"""
_GOV_VIEWS = ("v_outcome", "v_person_d", "v_condition", "v_indication", "v_medicine", "v_location")


@register("r1_medical_records_doctor", O.with_views(f"""
    SELECT o.person_id, {_REC}
    FROM v_outcome o, v_person_d pe, v_condition cd, v_indication i, v_medicine drug, v_location loc
    WHERE pe.person_id = o.person_id AND cd.disease_id = pe.disease_id AND i.indication_id = o.indication_id
      AND drug.medicine_id = i.medicine_id AND loc.location_id = pe.primary_location_id""", *_GOV_VIEWS))
def r1(spark, d):
    v = role_views(spark, d)
    patients = GV.patient_record(v.person(with_dates=True), v.condition(), v.location())
    return GV.medical_records_from(v.outcome_with(patients, cols=("indication_id",)),
                                   v.indication(), v.medicine())


register("r2_own_patient_rows", O.with_views(f"SELECT * FROM v_person_d WHERE person_id = {PATIENT}", "v_person_d"))(
    lambda spark, d: GV.PatientSession(PATIENT).patient(role_views(spark, d).person(with_dates=True)))
register("r3_own_outcome_rows", O.with_views(f"SELECT * FROM v_outcome WHERE person_id = {PATIENT}", "v_outcome"))(
    lambda spark, d: GV.PatientSession(PATIENT).outcome(role_views(spark, d).outcome()))


@register("r4_own_indication_rows", O.with_views(f"""
    SELECT * FROM v_indication i WHERE EXISTS (SELECT 1 FROM v_outcome o
        WHERE o.indication_id = i.indication_id AND o.person_id = {PATIENT})""", "v_indication", "v_outcome"))
def r4(spark, d):
    v = role_views(spark, d)
    return GV.PatientSession(PATIENT).indication(v.indication(), v.outcome())


@register("r6_patient_own_record", O.with_views(f"""
    SELECT mine.person_id, {_REC.replace("drug.name", "my_drugs.name")}
    FROM v_person_d pe
    LEFT JOIN v_location loc ON loc.location_id = pe.primary_location_id
    LEFT JOIN v_condition cd ON cd.disease_id = pe.disease_id
    LEFT JOIN mine ON mine.person_id = pe.person_id
    LEFT JOIN my_drugs ON my_drugs.indication_id = mine.indication_id
    WHERE pe.person_id = {PATIENT}""", *_GOV_VIEWS, extra=[
    ("mine", f"SELECT * FROM v_outcome WHERE person_id = {PATIENT}"),
    ("my_drugs", """SELECT i.indication_id, m.name FROM v_indication i JOIN v_medicine m ON m.medicine_id = i.medicine_id
                    WHERE i.indication_id IN (SELECT indication_id FROM mine)""")]))
def r6(spark, d):
    v = role_views(spark, d)
    return GV.my_record(GV.PatientSession(PATIENT), v.person(with_dates=True), v.location(), v.condition(),
                        v.outcome(), v.indication(), v.medicine())


# -- integrity A8, A9 ------------------------------------------------------------------------------
# Lengths that real rows break: customer names have 18 characters, segment names 8 to 10.
_PATIENT_LIMITS = {"last_name": 17, "first_name": 8, "gender": 1}


@register("a8_patient_rule_violations", O.with_views("""
    SELECT person_id, column_name, rule, length FROM (
        SELECT person_id, 'last_name' AS column_name, 'max length 17' AS rule, CAST(LENGTH(last_name) AS BIGINT) AS length
        FROM v_person WHERE LENGTH(last_name) > 17
        UNION ALL SELECT person_id, 'first_name', 'max length 8', CAST(LENGTH(first_name) AS BIGINT)
        FROM v_person WHERE LENGTH(first_name) > 8
        UNION ALL SELECT person_id, 'gender', 'max length 1', CAST(LENGTH(gender) AS BIGINT)
        FROM v_person WHERE LENGTH(gender) > 1
        UNION ALL SELECT person_id, 'gender', 'not null', CAST(NULL AS BIGINT) FROM v_person WHERE gender IS NULL) t""",
    "v_person"))
def a8(spark, d):
    _, bad = IG.apply_rules(role_views(spark, d).person(), {"severity_value": 1, "is_insured": False},
                            ["gender"], _PATIENT_LIMITS, key=["person_id"])
    return bad


# Foreign keys of the role views, stated on the tables they come from.
FK_CHECKS = [("lineitem", "l_orderkey", "orders", "o_orderkey"),
             ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
             ("lineitem", "l_partkey", "part", "p_partkey"),
             ("orders", "o_custkey", "customer", "c_custkey"),
             ("customer", "c_nationkey", "nation", "n_nationkey"),
             ("supplier", "s_nationkey", "nation", "n_nationkey"),
             ("nation", "n_regionkey", "region", "r_regionkey"),
             ("events", "user_id", "customer", "c_custkey")]
PK_CHECKS = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]),
             ("customer", ["c_custkey"]), ("supplier", ["s_suppkey"]), ("part", ["p_partkey"]),
             ("nation", ["n_nationkey"]), ("region", ["r_regionkey"])]


@register("a9_orphan_report", " UNION ALL ".join(
    f"""SELECT '{c}' AS child_table, '{fk}' AS fk_column, '{p}' AS parent_table, '{pk}' AS pk_column,
        COUNT(*) AS orphan_rows FROM {c} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)"""
    for c, fk, p, pk in FK_CHECKS))
def a9(spark, d):
    """All foreign keys at once: each table is read once."""
    v = role_views(spark, d)
    return orphan_report({t: v.raw(t) for t in dict.fromkeys(t for fk in FK_CHECKS for t in (fk[0], fk[2]))}, FK_CHECKS)


@register("a9_duplicate_key_report", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{','.join(k)}' AS key_columns, COUNT(*) AS duplicated_keys,
        CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows_with_duplicated_key
        FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1) g"""
    for t, k in PK_CHECKS))
def a9_dups(spark, d):
    v = role_views(spark, d)
    parts = [IG.dup_keys(v.raw(t), k, t) for t, k in PK_CHECKS]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


# -- A10 enrichment on arrival ---------------------------------------------------------------------
@register("a10_enrich_outcomes_batch", O.with_views("""
    SELECT o.*, i.medicine_id FROM v_outcome o LEFT JOIN v_indication i ON o.indication_id = i.indication_id""",
    "v_outcome", "v_indication"))
def a10(spark, d):
    v = role_views(spark, d)
    return enrich_on_arrival(v.outcome(), v.indication(), ("indication_id", "indication_id"), ["medicine_id"])


@register("a10_enrich_outcomes_stream", O.with_views("""
    SELECT o.*, i.medicine_id FROM v_outcome o LEFT JOIN v_indication i ON o.indication_id = i.indication_id""",
    "v_outcome", "v_indication"))
def a10_outcome_stream(spark, d):
    """The reference's trigger case as a stream: line items arrive, become outcome rows (a
    stream-static join with the orders) and get their indication's medicine on arrival."""
    v = role_views(spark, d)
    return run_arrivals(spark, f"{d}/lineitem.parque[t]", v.raw("lineitem").schema, v.indication(),
                        ("indication_id", "indication_id"), ["medicine_id"], prepare=v.outcome_from)


@register("a10_enrich_events_stream", O.with_views("""
    SELECT e.*, p.primary_location_id FROM events e LEFT JOIN v_person p ON e.user_id = p.person_id""", "v_person"))
def a10_stream(spark, d):
    v = role_views(spark, d)
    person = v.person().select("person_id", "primary_location_id")
    return run_arrivals(spark, f"{d}/events.parque[t]", v.raw("events").schema, person,
                        ("user_id", "person_id"), ["primary_location_id"])


# -- A2 + K1 + A10: the operational outcome table as the reference loads it -------------------

_OUTCOME_ORDER = ["outcome_date", "order_key", "line_number", "person_id", "indication_id", "outcome"]


@register("a2_load_outcome_table", O.with_views(f"""
    SELECT {O.rn(', '.join('o.' + c for c in _OUTCOME_ORDER))} AS outcome_id, o.person_id, o.indication_id, o.outcome, o.outcome_date,
           i.medicine_id
    FROM v_outcome o LEFT JOIN v_indication i ON o.indication_id = i.indication_id""", "v_outcome", "v_indication"))
def a2_outcome(spark, d):
    """Arriving outcome rows get their auto-numbered key (in arrival order: date, then order and
    line) and the trigger's medicine id, and are conformed to the declared outcome schema."""
    v = role_views(spark, d)
    rows_in = enrich_on_arrival(v.outcome(), v.indication(), ("indication_id", "indication_id"), ["medicine_id"])
    numbered = with_dense_id(rows_in, _OUTCOME_ORDER, "outcome_id")
    return conform(numbered, SCHEMAS["outcome"])


# -- the first month's KPIs: inputs that tell persons apart ------------------------------------------
MONTH = ("1996-01-01", "1996-01-31")
_MONTH_OUTCOME = [("v_outcome_month", f"SELECT * FROM v_outcome WHERE outcome_date BETWEEN DATE '{MONTH[0]}' AND DATE '{MONTH[1]}'")]


def _month_kpi(spark, d, fn):
    v = role_views(spark, d)
    outcome = v.outcome().where(F.col("outcome_date").between(F.lit(MONTH[0]).cast("date"), F.lit(MONTH[1]).cast("date")))
    return fn(outcome, v.medicine(), v.indication(), TARGET)


for _key, _fn in (("c1", kpi.c1_patients), ("c2", kpi.c2_other_patients)):
    _sql = _KPI_SQL[_key].replace("v_outcome", "v_outcome_month")
    register(f"{_key}_patients_of_one_month", O.with_views(_sql, *_KPI_VIEWS, extra=_MONTH_OUTCOME))(
        lambda spark, d, fn=_fn: _month_kpi(spark, d, fn))


# -- catalog tables, literal rows, key remapping, SCD batch, casts, governed sessions ----------------
_STORED = "healthmart_stored"


@register("a4_fact_read_back", O.dims_sql("""
    SELECT * FROM f_restated UNION ALL SELECT 0 AS fact_disease_intensity_id, NULL AS year_id, NULL AS disease_id, NULL AS intensity_level_id""",
    extra=_S1))
def a4_stored(spark, d):
    """Dimensions and the intensity fact stored in a catalog namespace, the change applied to the
    stored tables (each replaced by a version computed from itself), an INSERT ... SELECT and a literal
    row appended, and the fact read back."""
    v = role_views(spark, d)
    cat = Catalog(spark, scratch_namespace(spark, _STORED))
    dil, d_disease, d_level = _dil(v)
    d_year = W.dim_year(v.outcome_lines())
    for name, df in (("dim_disease", d_disease), ("dim_year", d_year), ("dim_intensity_level_quantity", d_level),
                     ("dim_disease_intensity_level", dil)):
        cat.replace(name, df)
    fact = FT.fact_disease_intensity(cat.scan("dim_year"), cat.scan("dim_disease_intensity_level"), cat.scan("dim_disease"),
                                     cat.scan("dim_intensity_level_quantity"))
    cat.replace("fact_disease_intensity", fact.limit(0))
    cat.append("fact_disease_intensity", fact, fact.columns)
    apply_intensity_change(cat, *SCD_CHANGE)
    cat.replace("fact_disease_intensity", append_rows(spark, cat.scan("fact_disease_intensity"), [{"fact_disease_intensity_id": 0}]))
    return cat.scan("fact_disease_intensity")


@register("a11_remap_medicine_key", O.with_views("""
    SELECT indication_id, CASE WHEN medicine_id % 2 = 0 THEN medicine_id + 1000 ELSE medicine_id END AS medicine_id, disease_id, dosage
    FROM v_indication""", "v_indication"))
def a11(spark, d):
    """Even medicine keys move up by 1000, and the indications follow."""
    v = role_views(spark, d)
    moved = v.medicine().where("medicine_id % 2 = 0").select("medicine_id", (F.col("medicine_id") + 1000).alias("new_id"))
    return remap_key(v.indication(), "medicine_id", moved, "medicine_id", "new_id")


_BATCH_LEVEL, _BATCH_YEAR = 3, 1999


@register("d4b_scd_batch", O.dims_sql(f"""
    SELECT intensity_level_scd_id, disease_name, intensity_level, start_year,
           CASE WHEN changed THEN {_BATCH_YEAR - 1} ELSE end_year END AS end_year, NOT changed AS is_current FROM (
        SELECT *, disease_name <> 'MACHINERY' AND intensity_level <> {_BATCH_LEVEL} AS changed FROM d_dil) t
    UNION ALL SELECT (SELECT MAX(intensity_level_scd_id) FROM d_dil) + ROW_NUMBER() OVER (ORDER BY disease_name), disease_name,
           {_BATCH_LEVEL}, {_BATCH_YEAR}, CAST(NULL AS BIGINT), TRUE FROM d_dil WHERE disease_name <> 'MACHINERY' AND intensity_level <> {_BATCH_LEVEL}""",
    extra=[_DIL]))
def d4b(spark, d):
    """Every condition but one gets level 3 from 1999, in one batch."""
    dil, _, _ = _dil(role_views(spark, d))
    changes = dil.where("disease_name <> 'MACHINERY'").select("disease_name", F.lit(_BATCH_LEVEL).cast("long").alias("intensity_level"))
    return scd2_apply(dil, changes, "disease_name", ["intensity_level"], _BATCH_YEAR, "intensity_level_scd_id")


@register("x8_strict_casts", "SELECT c_custkey, CAST(SUBSTR(c_name, 10) AS BIGINT) AS name_number FROM customer")
def x8(spark, d):
    """The number inside every customer name, cast strictly."""
    return role_views(spark, d).raw("customer").select("c_custkey", to_int_strict(F.substring("c_name", 10, 20)).alias("name_number"))


def _role_session(spark, d, role, person=None):
    def tables(session):
        v = role_views(session, d)
        return {"outcome": v.outcome(), "diseased_patient": v.person(with_dates=True), "disease": v.condition(),
                "indication": v.indication(), "medicine": v.medicine(), "location": v.location()}

    return GV.role_session(spark, tables, role, person)


register("r7_doctor_records", REGISTRY["r1_medical_records_doctor"].sql)(
    lambda spark, d: _role_session(spark, d, "doctor").table(GV.DOCTOR_VIEW))
register("r7_patient_outcomes", REGISTRY["r3_own_outcome_rows"].sql)(
    lambda spark, d: _role_session(spark, d, "patient", PATIENT).table("outcome"))
register("r7_patient_indications", REGISTRY["r4_own_indication_rows"].sql)(
    lambda spark, d: _role_session(spark, d, "patient", PATIENT).table("indication"))


@register("x9_session_value", O.with_views(f"""
    SELECT CAST({PATIENT} AS BIGINT) AS person_id, COUNT(*) AS outcomes FROM v_outcome WHERE person_id = {PATIENT}""", "v_outcome"))
def x9(spark, d):
    """The session's person, next to what its filtered view counts."""
    return _role_session(spark, d, "patient", PATIENT).sql("SELECT current_person_id AS person_id, COUNT(*) AS outcomes FROM outcome")


from . import change_queries, order_queries  # noqa: E402,F401  (they register their queries and build on the names above)
