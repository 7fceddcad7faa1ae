"""Structured Streaming jobs over the request log."""

from evalloom.streaming.ingest import append_stream, evaluate_batches, ingest, merge_batch, merge_batches, request_stream
from evalloom.streaming.windows import hourly_counts, sliding_pass_rate, stream_dedup

__all__ = [
    "append_stream", "evaluate_batches", "hourly_counts", "ingest", "merge_batch", "merge_batches", "request_stream", "sliding_pass_rate",
    "stream_dedup",
]
