"""Scans and sinks of the raw, cleaned and result zones, and the test fixture."""
