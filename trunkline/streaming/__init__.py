"""Incremental loading and enrichment with Structured Streaming."""

from trunkline.streaming.enrichment import enrich_calls_stream
from trunkline.streaming.incremental import (
    arriving_files,
    load_portability_stream,
    quarantined_files,
    retry_quarantined,
)

__all__ = [
    "arriving_files",
    "enrich_calls_stream",
    "load_portability_stream",
    "quarantined_files",
    "retry_quarantined",
]
