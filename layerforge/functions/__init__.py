"""Column builders: text normalisation, safe numerics, predicates and keys."""
