"""Column expressions and header-name rules."""
