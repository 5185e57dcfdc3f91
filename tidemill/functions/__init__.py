"""Column expressions and schemas."""
