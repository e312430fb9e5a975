"""Column expressions: statistics, scalars and geometry."""
