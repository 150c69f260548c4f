"""User-level jobs composed from the operators, one module per domain."""
