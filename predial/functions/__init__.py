"""Column expressions: all built-in, all inside generated code."""
