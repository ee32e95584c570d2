"""Incremental feeds on Structured Streaming (file source, availableNow, foreachBatch)."""
