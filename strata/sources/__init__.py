"""Scans (parquet, SQL, JDBC) and sinks (append, replace, modes, JSON)."""
