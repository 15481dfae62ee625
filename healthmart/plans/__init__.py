"""Composite jobs: KPIs and the merger (``kpi``), dimensions (``warehouse``), facts, star reads
and the SCD change (``facts``), governed reads (``governed``), catalog jobs (``jobs``)."""

from . import facts, governed, jobs, kpi, warehouse

__all__ = ["facts", "governed", "jobs", "kpi", "warehouse"]
