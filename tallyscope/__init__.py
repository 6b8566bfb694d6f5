"""Round-risk analytics as Spark DataFrame, SQL and Structured Streaming jobs."""

from tallyscope.settings import Thresholds

__all__ = ["Thresholds"]
