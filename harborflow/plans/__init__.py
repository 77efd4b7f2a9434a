"""Derived tables built from silver positions, state changes and ship static data."""
