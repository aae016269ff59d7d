"""Structured Streaming versions of the scoring jobs."""

from connscore.streaming.scoring import (
    record_stream, running_metrics, scored_stream, start_metrics, start_quarantine,
    start_scored_sink,
)

__all__ = ["record_stream", "running_metrics", "scored_stream", "start_metrics",
           "start_quarantine", "start_scored_sink"]
