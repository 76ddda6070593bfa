"""Column expressions the operators are made of. All are Spark built-ins, so they stay in generated code."""
