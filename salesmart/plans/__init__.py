"""Composed jobs, the hour/day drivers and the query catalogue."""
