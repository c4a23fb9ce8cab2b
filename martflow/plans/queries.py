"""All registered queries by name."""

from __future__ import annotations

from martflow.plans import queries_answers, queries_audit, queries_forecast, queries_kpis, queries_marts, queries_quality
from martflow.plans.registry import Query

QUERIES: dict[str, Query] = {
    **queries_quality.QUERIES,
    **queries_marts.QUERIES,
    **queries_audit.QUERIES,
    **queries_answers.QUERIES,
    **queries_forecast.QUERIES,
    **queries_kpis.QUERIES,
}
