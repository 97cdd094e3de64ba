"""All registered queries."""

from __future__ import annotations

from listinglake.workload import (  # noqa: F401
    children, health, html_sources, json_sources, landed, offers, rates, reports, texts,
)
from listinglake.workload.tables import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
