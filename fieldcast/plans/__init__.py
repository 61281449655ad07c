"""Plans: the composite jobs and queries built from the operators."""
