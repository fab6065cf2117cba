"""Scans, sinks and the scratch tables that cut lineage."""
