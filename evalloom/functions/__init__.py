"""Column builders: they take Columns (or column names) and return Columns."""
