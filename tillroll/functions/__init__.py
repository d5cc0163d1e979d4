"""Column expressions; every one is a built-in, so it stays inside code generation."""
