"""Report tables composed from the operators."""
