"""The seven reader exports, from models to CSV."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from kerbside.plans import anomalies, metrics
from kerbside.plans.models import Models
from kerbside.sources.sinks import export_csv

_FUNNEL = ("int_sessions", "int_searches", "fct_bookings", "int_cancellations")
_REVENUE = ("fct_bookings", "int_cancellations")

# Each export by name, with its query, which is sorted.
EXPORTS = {
    "funnel_by_segment": lambda m: metrics.funnel_by_segment(*[m[n] for n in _FUNNEL]),
    "funnel_stages": lambda m: metrics.funnel_stages(*[m[n] for n in _FUNNEL]),
    "top_partners": lambda m: metrics.top_partners(*[m[n] for n in _REVENUE], m["dim_partners"]),
    "ltv_cohort": lambda m: metrics.ltv_cohort(*[m[n] for n in _REVENUE], m["dim_users"]),
    "search_bursts": lambda m: anomalies.search_bursts(m["stg_searches"], m["stg_sessions"]),
    "cancellation_outliers": lambda m: metrics.cancellation_outliers(*[m[n] for n in _REVENUE], m["dim_partners"]),
    "monthly_evolution": lambda m: metrics.monthly_evolution(*[m[n] for n in _REVENUE]),
}


def export_results(models: Models | dict[str, DataFrame], folder: str, names: Iterable[str] = tuple(EXPORTS)) -> None:
    """Write the named exports under ``folder``, each as a CSV of its own."""
    for name in names:
        export_csv(EXPORTS[name](models), f"{folder}/{name}")
