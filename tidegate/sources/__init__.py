"""Readers: catalog CSV files, dictionary snapshots and day-partitioned tables."""
