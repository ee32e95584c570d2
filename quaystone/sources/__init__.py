"""Readers, layout checks and sinks."""
