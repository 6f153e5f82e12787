"""Test input: shop data derived from the driver's generic tables.

No job of ``shoplens`` imports this; the query registry, the oracle SQL and
the tests do.
"""
