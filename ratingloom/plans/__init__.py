"""Reports composed from the operators, and the run that produces them all."""
