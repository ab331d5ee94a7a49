"""Feeds, reference data and the run-partitioned table store."""
