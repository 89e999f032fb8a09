"""Column-expression building blocks (parsing guards, hashes, rules)."""
