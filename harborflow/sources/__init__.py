"""Scans, decoding, routing, zone files, table sinks and exports."""
