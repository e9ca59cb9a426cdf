"""Column functions: instants, run identity and object keys."""
