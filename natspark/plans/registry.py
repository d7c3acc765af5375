"""All queries of the session-log library and their SQL."""

from __future__ import annotations

from natspark.plans import health_queries, report_queries


def queries() -> dict:
    return report_queries.ALL | health_queries.ALL


def oracle_sql() -> dict[str, str]:
    return report_queries.SQL | health_queries.SQL
