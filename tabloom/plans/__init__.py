"""Job-level compositions of the operators."""
