"""Column expressions and key generation shared by the operators."""
