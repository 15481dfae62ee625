"""Health-mart analytics on Spark.

Operational tables (patients, conditions, medicines, indications, margins, outcomes)
go in; company KPIs, a star schema with deterministic surrogate keys, aggregate
outcome facts, a slowly changing intensity dimension, enrichment on arrival,
integrity reports and row-filtered reads come out.  Every operator is a function
from DataFrames to DataFrames; nothing is collected to the driver except bounded
bookkeeping (per-partition row counts in the surrogate-key builder).
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
