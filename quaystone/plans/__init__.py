"""Bindings of the operators to the driver's tables: queries() and their DuckDB twins."""
