"""Whole jobs, and the queries that exercise each operator on the driver tables."""
