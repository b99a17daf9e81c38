"""Column expressions (built-in Spark functions only): parsing, lookups, calendar, metrics."""
