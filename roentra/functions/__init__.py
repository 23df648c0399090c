"""Column expressions. Everything here is a built-in expression tree, no Python rows."""
