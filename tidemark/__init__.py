"""Incremental loads and small marts as plain Spark DataFrame operators."""

from tidemark.spec import FeedSpec

__all__ = ["FeedSpec"]
