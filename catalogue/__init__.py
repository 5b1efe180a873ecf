"""Named queries over the order-and-lineitem tables, each with its SQL counterpart where one exists."""

from catalogue.base import ORACLES, QUERIES
from catalogue import (  # noqa: F401  (importing registers the queries)
    aggregate_queries,
    feature_queries,
    join_queries,
    learning_queries,
    projection_queries,
    quality_queries,
    risk_queries,
    source_queries,
    window_queries,
)

__all__ = ["ORACLES", "QUERIES"]
