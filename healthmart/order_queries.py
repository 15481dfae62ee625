"""Registered queries that show what the others leave open: the order of ordered reads (O1-O3), as a
column with each row's place in it, and names written in any case (P10).  Importing this module
registers them in ``queries.REGISTRY``.
"""

from __future__ import annotations

from . import oracle as O
from .operators.keys import with_place
from .queries import REGISTRY, register
from .sources.roles import register_views


def _in_order(name: str, read: str, order: str) -> None:
    """Register ``name``: the rows of the registered ordered read ``read`` with their place."""
    query = REGISTRY[read]
    register(name, f"SELECT t.*, {O.rn(order)} AS place FROM ({query.sql}) t")(
        lambda spark, d: with_place(query.build(spark, d), "place"))


_in_order("o1_companies_by_patients", "c3_patients_per_company", "patient_count DESC NULLS FIRST, company_name NULLS LAST")
_in_order("o1_companies_by_profit", "c6_profit_per_company", "total_profit DESC NULLS FIRST, company_name NULLS LAST")
_in_order("o2_products_by_ingredient", "c7_competing_products", "active_ingredient_name NULLS LAST, medicine_id")
_in_order("o2_intensity_by_year", "v3_star_intensity", "year NULLS LAST, disease_name NULLS LAST")
_in_order("o3_star_in_order", "v1_star_outcome",
          "effectiveness DESC NULLS FIRST, avg_cost_per_drug DESC NULLS FIRST, fact_disease_outcome_id")
_in_order("o3_star_no_country_in_order", "v2_star_outcome_no_country",
          "effectiveness NULLS LAST, avg_cost_per_drug DESC NULLS FIRST, fact_disease_outcome_id")


@register("p10_names_in_any_case", O.with_views("""
    SELECT m.company AS company_name, COUNT(*) AS indications
    FROM v_medicine m JOIN v_indication i ON i.medicine_id = m.medicine_id GROUP BY m.company""", "v_medicine", "v_indication"))
def p10(spark, d):
    """P10: unquoted names of tables, columns and aliases resolve in any case."""
    session = spark.newSession()        # its temp views stay out of the caller's sight
    register_views(session, d)
    return session.sql("""SELECT M.Company AS company_name, COUNT(*) AS indications
        FROM MEDICINE m JOIN Indication I ON i.MEDICINE_ID = M.medicine_id GROUP BY m.COMPANY""")
