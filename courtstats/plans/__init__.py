"""Ready-made analyses built from the operators."""
