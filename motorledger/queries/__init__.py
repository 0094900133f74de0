"""Every operator run over the driver tables, each with an equivalent SQL statement."""

from motorledger.queries import (  # noqa: F401 - importing registers the queries
    columns,
    groups,
    joins,
    marts,
    quality,
    scalars,
    scans,
    shapes,
    sinks,
)
from motorledger.queries.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
