"""Column expressions and the few frame-level helpers the operators share."""
