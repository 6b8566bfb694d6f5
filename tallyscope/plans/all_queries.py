"""Importing this module registers every query."""

from tallyscope.plans import (  # noqa: F401
    case_queries, feature_queries, review_queries, rule_queries, stream_queries,
)
