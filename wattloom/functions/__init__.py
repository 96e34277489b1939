"""Column expressions: conforming, vectors, geography."""
