"""Column functions: text, maps, vectors, predicates."""
