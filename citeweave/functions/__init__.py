"""Column functions: patterns, predicates, text and identifier functions."""
