"""Column expressions: tolerant casts, text repair, date keys, vectors."""
