"""Structured Streaming jobs: per-day device dedup, first-order state,
late-row reconciliation, and the window-by-window replay runner."""
