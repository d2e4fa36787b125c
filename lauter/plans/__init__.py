"""Jobs and queries built from the operators."""
