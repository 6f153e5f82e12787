"""Whole jobs composed from operators, the query registry and its oracle SQL."""
