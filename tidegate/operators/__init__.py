"""Operators over catalogs (columns, positions) and over table data (spec, audits, profiles, layout)."""
