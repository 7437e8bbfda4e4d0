"""Named queries composed from the operators."""
