"""Structured Streaming versions of parsing, pairing, time-bin counts, threat rules and scoring."""

from .jobs import (parse_stream, pair_stream, closed_stream, run_available, counts_stream, closed_windows_stream, port_scan_stream, score_batches, start_memory_query)

__all__ = ["parse_stream", "pair_stream", "closed_stream", "run_available", "counts_stream", "closed_windows_stream", "port_scan_stream", "score_batches",
           "start_memory_query"]
