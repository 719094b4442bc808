"""Column expressions used by the operators (parsing, zone-free time)."""
