"""Library-shaped test relations derived from the given tables, for Spark and for the SQL oracle."""
