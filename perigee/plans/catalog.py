"""The registered queries and their DuckDB counterparts."""

from __future__ import annotations

from perigee.plans import asof_queries, catalogue_queries, image_queries, ingest_queries, inventory_queries, merge_queries, packet_queries, recovery_queries, science_queries, stream_queries, value_queries  # noqa: F401  they register themselves
from perigee.plans.base import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return dict(ORACLES)
