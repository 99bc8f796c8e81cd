"""Stateful replays of event logs with Structured Streaming."""
