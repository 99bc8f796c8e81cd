"""Checks, joins, aggregates and ordered replays over evidence tables."""
