"""Reports, measures and whole jobs composed from the operators."""
