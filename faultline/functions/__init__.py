"""Column expressions: plain compositions of built-in functions, no Python UDFs."""
