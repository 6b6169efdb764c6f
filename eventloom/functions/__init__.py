"""Column expressions: coercion, hashing for samples, keys and sets of tags."""
