"""SQL that computes the expected results independently, from the plain test tables."""
