"""Column expressions: types, names and text. No UDFs; everything stays inside the JVM."""
