"""Business stages built from the generic operators."""
