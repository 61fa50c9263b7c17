"""Jobs over the operators."""
