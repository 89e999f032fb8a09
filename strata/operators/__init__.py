"""Pipeline operators: bronze, DLQ, silver, gold, catalog, quality, history."""
