"""Column expressions: comparison, measures, statuses and message texts."""
