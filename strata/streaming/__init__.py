"""Incremental ingestion with Structured Streaming."""

from strata.streaming.incremental import incremental_silver

__all__ = ["incremental_silver"]
