"""Table migration on PySpark: type mapping, data audits, day layout and table definitions."""
