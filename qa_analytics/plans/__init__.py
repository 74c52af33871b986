"""Composed jobs, test-table views and the query catalogue."""
