"""Column expressions: every rule stays inside generated code, none is a Python function per row."""
