"""Column -> Column scalar functions (native expressions, no UDF)."""
