"""Column expressions and the few Arrow functions Spark has no built-in for."""
