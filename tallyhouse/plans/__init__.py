"""Whole jobs, reports, the session and the query registry."""
