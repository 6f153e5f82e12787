"""Readers: strict NDJSON, table scans, JDBC options, fixture views."""
