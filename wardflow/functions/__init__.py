"""Column expressions: message text, keys, code maps and value cleaning."""
