"""Scans of source snapshots and sinks of ledgers."""
