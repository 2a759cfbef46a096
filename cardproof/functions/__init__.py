"""Column expressions and the transaction schema."""
