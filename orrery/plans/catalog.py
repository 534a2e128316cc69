"""The registered queries over the driver's tables and the SQL that each must match."""

from __future__ import annotations

from orrery.plans import assessment_queries, matching_queries, series_queries, survey_queries, timing_queries, vetting_queries

MODULES = [survey_queries.R, series_queries.R, matching_queries.R, assessment_queries.R, vetting_queries.R, timing_queries.R]


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
