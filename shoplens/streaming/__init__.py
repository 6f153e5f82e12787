"""Structured Streaming stages: L0 -> MART cleaning, dedup, upsert, alerts."""
