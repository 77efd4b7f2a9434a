"""Structured Streaming jobs: silver positions, ship static data, vessel state changes."""
