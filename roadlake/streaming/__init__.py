"""Structured Streaming variants: incremental clean, windows, dedupe, latest."""

from roadlake.streaming.incremental import (clean_stream, dedupe, hourly_windows,
                                            latest_state, start_clean, start_curate,
                                            start_dedupe, start_quarantine)
from roadlake.streaming.windows import drain, read_windows, start_hourly_state

__all__ = ["clean_stream", "dedupe", "hourly_windows", "latest_state",
           "start_clean", "start_curate", "start_dedupe", "start_quarantine",
           "drain", "read_windows", "start_hourly_state"]
