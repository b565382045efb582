"""Typed scans, raw landing with validation, table sinks and registration."""
