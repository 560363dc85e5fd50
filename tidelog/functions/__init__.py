"""Column functions: payload decode and partition derivation."""
