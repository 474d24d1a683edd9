"""Column expressions and small frame-to-frame cleaning steps."""
