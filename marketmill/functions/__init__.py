"""Column expressions and window patterns shared by the operators."""
