"""Column builders.  Each takes and returns Spark columns; none runs Python per row."""
