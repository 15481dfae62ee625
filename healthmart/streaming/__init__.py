from .arrival import enrich_on_arrival, run_arrivals

__all__ = ["enrich_on_arrival", "run_arrivals"]
