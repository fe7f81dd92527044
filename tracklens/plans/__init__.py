"""Whole-job plans: the encounter pipeline, the query catalog used by the
driver contract, and the DuckDB oracle SQL used to verify it."""
