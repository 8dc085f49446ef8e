"""Column expressions: dates and packed times, text, predicates, code maps."""
