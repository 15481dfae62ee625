"""Independent SQL for every registered query, run by DuckDB over the driver's tables.

views are stated again as SQL, and each query is direct SQL - plain joins, FILTER aggregates, window
counts.  Output columns, their order and the join conditions of the record views are those the
definitions prescribe.  Explicit casts make
both engines return the same types: BIGINT for counts and ids, DECIMAL(10,2)/(38,2) for money,
DATE for dates.
"""

from __future__ import annotations

# -- role views ----------------------------------------------------------------------------
V = {
    "v_outcome": """
        SELECT l.l_orderkey AS order_key, CAST(l.l_linenumber AS BIGINT) AS line_number,
               o.o_custkey AS person_id, l.l_suppkey AS indication_id,
               CASE WHEN l.l_returnflag = 'N' THEN 'recovered'
                    WHEN l.l_returnflag = 'A' THEN 'worsened'
                    WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'died'
                    WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'relapse' END AS outcome,
               CAST(l.l_shipdate AS DATE) AS outcome_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_outcome_part": """
        SELECT l.l_orderkey AS order_key, CAST(l.l_linenumber AS BIGINT) AS line_number,
               o.o_custkey AS person_id, l.l_partkey AS indication_id,
               CASE WHEN l.l_returnflag = 'N' THEN 'recovered'
                    WHEN l.l_returnflag = 'A' THEN 'worsened'
                    WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'died'
                    WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'relapse' END AS outcome,
               CAST(l.l_shipdate AS DATE) AS outcome_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_indication_part": """
        SELECT p_partkey AS indication_id, p_partkey AS medicine_id, p_partkey % 5 + 1 AS disease_id,
               'dose-' || p_partkey AS dosage FROM part""",
    "v_indication": """
        SELECT s_suppkey AS indication_id, CAST(s_nationkey AS BIGINT) AS medicine_id,
               s_suppkey % 5 + 1 AS disease_id, 'dose-' || CAST(s_suppkey AS VARCHAR) AS dosage
        FROM supplier""",
    "v_profit_c": """
        SELECT s_suppkey AS profit_id, s_suppkey AS indication_id,
               CAST(ROUND(s_acctbal * 100) AS BIGINT) AS profit_cents FROM supplier""",
    "v_profit": """
        SELECT profit_id, indication_id, profit_cents, ABS(profit_cents) AS cost_cents,
               CAST(CAST(ABS(profit_cents) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS cost,
               CAST(CAST(ABS(profit_cents) + profit_cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS price,
               CAST(CAST(profit_cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS profit,
               CAST(CAST(CASE WHEN ABS(profit_cents) > 0 THEN SIGN(profit_cents) *
                    ((ABS(profit_cents * 10000) * 2 + ABS(profit_cents)) // (ABS(profit_cents) * 2)) END
                    AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS percentage_profit
        FROM v_profit_c""",
    "v_medicine": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS medicine_id, 'SIN' || CAST(n.n_nationkey AS VARCHAR) AS standard_industry_number,
               n.n_name AS name, r.r_name AS company, n.n_name AS active_ingredient_name
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_medicine_part": """
        SELECT p_partkey AS medicine_id, 'SIN' || CAST(p_partkey AS VARCHAR) AS standard_industry_number,
               p_type AS name, p_brand AS company, p_name AS active_ingredient_name
        FROM part""",
    "v_condition_n": """
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_mktsegment) AS BIGINT) AS disease_id, c_mktsegment AS disease_name
        FROM (SELECT DISTINCT c_mktsegment FROM customer) s""",
    "v_condition": """
        SELECT disease_id, disease_name, disease_id + 6 AS intensity_level_qty,
               'DT0' || CAST(disease_id AS VARCHAR) AS disease_type_code FROM v_condition_n""",
    "v_person": """
        SELECT c.c_custkey AS person_id, c.c_name AS last_name, LOWER(c.c_mktsegment) AS first_name,
               CASE c.c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'X' END AS gender,
               CAST(c.c_nationkey AS BIGINT) AS primary_location_id, c.c_custkey % 101 AS age,
               cd.disease_id, CAST(c.c_nationkey % 10 + 1 AS BIGINT) AS severity_value,
               c.c_acctbal >= 0 AS is_insured
        FROM customer c LEFT JOIN v_condition cd ON c.c_mktsegment = cd.disease_name""",
    "v_person_d": """
        SELECT p.*, s.start_date, s.end_date FROM v_person p LEFT JOIN (
            SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS start_date, CAST(MAX(o_orderdate) AS DATE) AS end_date
            FROM orders GROUP BY o_custkey) s ON p.person_id = s.o_custkey""",
    "v_location": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS location_id, n.n_name AS city_name, n.n_name AS state_province_name,
               r.r_name AS country_name, CASE WHEN r.r_name IN ('AFRICA', 'ASIA') THEN 'Y' ELSE 'N' END AS developing_flag,
               CAST(n.n_nationkey % 10 + 1 AS BIGINT) AS wealth_rank_number
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
}
# Views that other views read.
DEPS = {"v_profit": ["v_profit_c"], "v_condition": ["v_condition_n"], "v_person": ["v_condition"],
        "v_person_d": ["v_person"]}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in out:
            out.append(n)
    for n in names:
        add(n)
    return out


def with_views(body: str, *names: str, extra: list[tuple[str, str]] = ()) -> str:
    ctes = [f"{n} AS ({V[n]})" for n in _closure(list(names))]
    ctes += [f"{n} AS ({q})" for n, q in extra]
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return "WITH " + ",\n".join(ctes) + sep + body


def money(x: str) -> str:
    """Integer hundredths -> DECIMAL(10,2)."""
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2))"


def half_up(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN SIGN({num}) * ((ABS({num}) * 2 + ({den})) // (({den}) * 2)) END)"


def ratio_money(num: str, den: str, scale: int = 1) -> str:
    return money(half_up(f"({num}) * {scale}", den))


# -- KPIs (C1-C6, C11) ---------------------------------------------------------------------

def kpi_sql(company: str, medicine_cte: str = "v_medicine") -> dict[str, str]:
    """C1-C6 over the medicine table ``medicine_cte`` (the original or the merged one)."""
    drug = f"""v_indication i JOIN {medicine_cte} m ON m.medicine_id = i.medicine_id"""
    target = f"SELECT i.indication_id FROM {drug} WHERE m.company = '{company}'"
    return {
        "c1": f"""SELECT COUNT(DISTINCT o.person_id) AS target_patients
                  FROM v_outcome o WHERE o.indication_id IN ({target})""",
        "c2": f"""SELECT COUNT(DISTINCT o.person_id) AS other_patients
                  FROM v_outcome o WHERE o.indication_id NOT IN ({target})""",
        "c3": f"""SELECT m.company AS company_name, COUNT(DISTINCT o.person_id) AS patient_count
                  FROM v_outcome o JOIN {drug} ON i.indication_id = o.indication_id
                  GROUP BY m.company""",
        "c4": f"""SELECT CAST(SUM(p.profit) AS DECIMAL(38,2)) AS target_total_profit
                  FROM v_outcome o JOIN v_profit p ON p.indication_id = o.indication_id
                  WHERE o.indication_id IN ({target})""",
        "c5": f"""SELECT CAST(SUM(p.profit) AS DECIMAL(38,2)) AS other_total_profit
                  FROM v_outcome o JOIN v_profit p ON p.indication_id = o.indication_id
                  WHERE o.indication_id IN (SELECT i.indication_id FROM {drug} WHERE m.company <> '{company}')""",
        "c6": f"""SELECT m.company AS company_name, CAST(SUM(p.profit) AS DECIMAL(38,2)) AS total_profit
                  FROM v_outcome o JOIN {drug} ON i.indication_id = o.indication_id
                  JOIN v_profit p ON p.indication_id = o.indication_id
                  GROUP BY m.company""",
    }


def merged_medicine_sql(src: str, acquirer: str, acquired: str) -> list[tuple[str, str]]:
    """C9 then C10 as CTEs over ``src``; the last CTE is ``{src}_merged``."""
    return [
        (f"{src}_acq", f"""SELECT active_ingredient_name, MIN(name) AS acquirer_name FROM {src}
                          WHERE company = '{acquirer}' GROUP BY active_ingredient_name"""),
        (f"{src}_renamed", f"""SELECT m.medicine_id, m.standard_industry_number,
                    CASE WHEN m.company = '{acquired}' AND acq.active_ingredient_name IS NOT NULL
                         THEN acq.acquirer_name ELSE m.name END AS name,
                    m.company, m.active_ingredient_name
                FROM {src} m LEFT JOIN {src}_acq acq ON m.active_ingredient_name = acq.active_ingredient_name"""),
        (f"{src}_merged", f"""SELECT medicine_id, standard_industry_number, name,
                    CASE WHEN company = '{acquired}' THEN '{acquirer}' ELSE company END AS company,
                    active_ingredient_name FROM {src}_renamed"""),
    ]


# -- warehouse (M1-M11, B1-B3, V1-V4, S1j) ---------------------------------------------------

# Inclusive upper bounds and labels of the age buckets; the last one has no bound and
# also takes a NULL age.
AGES = [(10, "0-10"), (20, "11-20"), (30, "21-30"), (40, "31-40"), (50, "41-50"), (60, "51-60"), (70, "61-70"), (None, "71+")]


def age_bucket(col: str) -> str:
    """Number of the bucket, 1 to 8."""
    return "CAST(CASE " + " ".join(f"WHEN {col} <= {top} THEN {n}" for n, (top, _) in enumerate(AGES, 1) if top) + f" ELSE {len(AGES)} END AS BIGINT)"


def age_range(col: str) -> str:
    """Label of the bucket."""
    return "CASE " + " ".join(f"WHEN {col} <= {top} THEN '{label}'" for top, label in AGES if top) + f" ELSE '{AGES[-1][1]}' END"


def rn(order: str) -> str:
    return f"CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS BIGINT)"


def nsafe(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


DIS = ["disease_name", "intensity_level_qty", "disease_type_code"]
LOC = ["city_name", "state_province_name", "country_name", "developing_flag", "wealth_rank_number"]
PRO = ["cost", "price", "profit", "percentage_profit"]

DIMS: list[tuple[str, str]] = [
    ("d_age", f"SELECT DISTINCT {age_bucket('age')} AS age_id, {age_range('age')} AS age_range FROM v_person"),
    ("d_disease", f"""SELECT {rn('src')} AS disease_id, {', '.join(DIS)} FROM
        (SELECT {', '.join(DIS)}, MIN(disease_id) AS src FROM v_condition GROUP BY {', '.join(DIS)}) t"""),
    ("disease_map", f"""SELECT c.disease_id AS src_id, d.disease_id AS dim_id FROM v_condition c
        JOIN d_disease d ON {nsafe('c', 'd', DIS)}"""),
    ("d_gender", f"""SELECT {rn('gender')} AS gender_id, gender,
        CASE WHEN gender = 'M' THEN 'Male' WHEN gender = 'F' THEN 'Female' ELSE 'Unknown' END AS gender_desc
        FROM (SELECT DISTINCT gender FROM v_person WHERE gender IS NOT NULL) t"""),
    ("d_location", f"""SELECT {rn('src')} AS location_id, {', '.join(LOC)} FROM
        (SELECT {', '.join(LOC)}, MIN(location_id) AS src FROM v_location GROUP BY {', '.join(LOC)}) t"""),
    ("location_map", f"""SELECT c.location_id AS src_id, d.location_id AS dim_id FROM v_location c
        JOIN d_location d ON {nsafe('c', 'd', LOC)}"""),
    ("d_profit", f"""SELECT {rn('src')} AS profit_id, {', '.join(PRO)} FROM
        (SELECT {', '.join(PRO)}, MIN(profit_id) AS src FROM v_profit GROUP BY {', '.join(PRO)}) t"""),
    ("d_year", f"""SELECT {rn('year')} AS year_id, year FROM
        (SELECT DISTINCT CAST(EXTRACT(YEAR FROM outcome_date) AS BIGINT) AS year FROM v_outcome) t"""),
    ("d_level", f"""SELECT {rn('intensity_level_qty')} AS intensity_level_id, intensity_level_qty AS intensity_level
        FROM (SELECT DISTINCT intensity_level_qty FROM v_condition WHERE intensity_level_qty IS NOT NULL) t"""),
]
DIM_VIEWS = ("v_person", "v_condition", "v_location", "v_profit", "v_outcome")


def dims_sql(body: str, *more_views: str, extra: list[tuple[str, str]] = ()) -> str:
    return with_views(body, *DIM_VIEWS, *more_views, extra=DIMS + list(extra))


def dil_sql(start: int, end: int) -> tuple[str, str]:
    """Initial SCD-2 load: every condition current with the default validity, ids by source id."""
    return ("d_dil", f"""SELECT {rn('c.disease_id, c.disease_name, l.intensity_level')} AS intensity_level_scd_id,
        c.disease_name, l.intensity_level, CAST({start} AS BIGINT) AS start_year, CAST({end} AS BIGINT) AS end_year,
        TRUE AS is_current
        FROM v_condition c JOIN d_level l ON l.intensity_level = c.intensity_level_qty
        WHERE c.disease_name IN (SELECT disease_name FROM d_disease)""")


def dil_changed_sql(name: str, level: str, from_year: int, to_year: int) -> tuple[str, str]:
    """The change batch: the current version of ``name`` ends the year before ``from_year``; a
    new current version with ``level`` is appended with the next id."""
    return ("d_dil2", f"""
        SELECT intensity_level_scd_id, disease_name, intensity_level, start_year,
               CASE WHEN closes THEN CAST({from_year - 1} AS BIGINT) ELSE end_year END AS end_year,
               is_current AND NOT closes AS is_current
        FROM (SELECT v.*, COALESCE(v.is_current AND v.disease_name = '{name}'
                                   AND '{name}' IN (SELECT disease_name FROM d_disease), FALSE) AS closes
              FROM d_dil v) t
        UNION ALL
        SELECT MAX(intensity_level_scd_id) + 1, '{name}', CAST('{level}' AS BIGINT), CAST({from_year} AS BIGINT),
               CAST({to_year} AS BIGINT), TRUE
        FROM d_dil""")


def _covered(dil: str) -> str:
    """(year_id, disease_id, level) for every year inside a current version."""
    return f"""SELECT y.year_id, y.year, d.disease_id, v.intensity_level
        FROM {dil} v JOIN d_year y ON y.year >= v.start_year AND (v.end_year IS NULL OR y.year <= v.end_year)
        JOIN d_disease d ON d.disease_name = v.disease_name
        WHERE v.is_current"""


def intensity_fact_sql(dil: str, name: str = "f_int") -> tuple[str, str]:
    return (name, f"""SELECT {rn('c.year, c.disease_id')} AS fact_disease_intensity_id, c.year_id, c.disease_id,
            l.intensity_level_id
        FROM ({_covered(dil)}) c JOIN d_level l ON l.intensity_level = c.intensity_level""")


def restated_sql(fact: str, dil: str) -> tuple[str, str]:
    """Fact rows covered by a current version take that version's level id (NULL if the level has
    no dimension row); the others keep theirs."""
    return ("f_restated", f"""
        SELECT f.fact_disease_intensity_id, f.year_id, f.disease_id,
               CASE WHEN c.year_id IS NULL THEN f.intensity_level_id ELSE l.intensity_level_id END AS intensity_level_id
        FROM {fact} f
        LEFT JOIN ({_covered(dil)}) c ON c.year_id = f.year_id AND c.disease_id = f.disease_id
        LEFT JOIN d_level l ON l.intensity_level = c.intensity_level""")


def outcome_fact_sql(with_location: bool) -> list[tuple[str, str]]:
    """B1 (with location) or B2 as CTEs ``cells*`` and ``f_outcome*``.

    Every outcome row of a patient with a complete cell counts once (B1) - weighted for the cost
    mean by how often its indication occurs among all outcomes.  B2 pairs every outcome row with
    every (cost, count) row of the patient's own cost table, as the definition states.
    """
    suffix = "" if with_location else "_nc"
    keys = ["disease_id", "age_id", "gender_id"] + (["location_id"] if with_location else [])
    key_list = ", ".join(keys)
    cells = (f"""SELECT pe.person_id, dm.dim_id AS disease_id, {age_bucket('pe.age')} AS age_id, g.gender_id"""
             + (", lm.dim_id AS location_id" if with_location else "")
             + """ FROM v_person pe JOIN disease_map dm ON dm.src_id = pe.disease_id
                   JOIN d_gender g ON g.gender = pe.gender"""
             + (" JOIN location_map lm ON lm.src_id = pe.primary_location_id" if with_location else ""))
    if with_location:
        rows = f"""SELECT c.*, o.outcome, p.cost_cents, p.profit_cents, fr.n AS weight, fr.n * p.cost_cents AS weighted_cost
            FROM cells{suffix} c JOIN v_outcome o ON o.person_id = c.person_id
            JOIN v_profit p ON p.indication_id = o.indication_id
            JOIN (SELECT indication_id, COUNT(*) AS n FROM v_outcome GROUP BY indication_id) fr
              ON fr.indication_id = o.indication_id
            WHERE o.indication_id IN (SELECT indication_id FROM v_indication)"""
    else:
        rows = f"""SELECT c.*, o.outcome, p.cost_cents, p.profit_cents, pc.n AS weight, pc.n * pc.cost_cents AS weighted_cost
            FROM cells{suffix} c JOIN v_outcome o ON o.person_id = c.person_id
            JOIN v_profit p ON p.indication_id = o.indication_id
            JOIN (SELECT oo.person_id, pp.cost_cents, COUNT(*) AS n
                  FROM v_outcome oo JOIN v_profit pp ON pp.indication_id = oo.indication_id
                  GROUP BY oo.person_id, pp.cost_cents) pc ON pc.person_id = o.person_id
            WHERE o.indication_id IN (SELECT indication_id FROM v_indication)"""
    agg = f"""SELECT {key_list},
            COUNT(*) FILTER (WHERE outcome = 'recovered') AS rec, COUNT(*) FILTER (WHERE outcome = 'worsened') AS wor,
            COUNT(*) FILTER (WHERE outcome = 'died') AS died, COUNT(*) FILTER (WHERE outcome = 'relapse') AS rel,
            COUNT(*) AS n, SUM(weighted_cost) AS wsum, SUM(weight) AS wcnt, SUM(profit_cents) AS psum
        FROM ({rows}) r GROUP BY {key_list}"""
    overall = f"(SELECT {ratio_money('SUM(cost_cents)', 'COUNT(cost_cents)')} FROM v_profit)"
    body = f"""SELECT {rn(key_list)} AS fact_disease_outcome_id, {key_list},
            rec AS recovered_count, wor AS worsened_count, died AS died_count, rel AS relapsed_count,
            {ratio_money('rec', 'n', 10000)} AS effectiveness,
            CASE WHEN wcnt > 0 THEN {ratio_money('wsum', 'wcnt')} ELSE CAST(0 AS DECIMAL(10,2)) END AS avg_cost_per_drug,
            {overall} AS overall_avg_cost,
            {ratio_money('psum', 'n')} AS avg_profit
        FROM ({agg}) a"""
    return [(f"cells{suffix}", cells), (f"f_outcome{suffix}", body)]
