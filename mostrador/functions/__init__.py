"""Column expressions: casting text, deriving features, normalising keys."""
