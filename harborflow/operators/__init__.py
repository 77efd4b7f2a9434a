"""Relational operators: ordered scans, spatial joins, quality, state machine, as-of join."""
