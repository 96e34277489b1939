"""Compositions of operators, and the state that runs advance."""
