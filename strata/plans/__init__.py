"""Composed jobs: fixtures derived from the driver tables, the medallion
run, run audits, and the query registry."""
