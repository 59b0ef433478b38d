"""Whole jobs: catalog extract, table definitions, migration report, registered queries."""
