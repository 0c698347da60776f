"""Column expressions and predicates shared by the operators."""
