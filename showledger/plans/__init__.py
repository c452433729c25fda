"""User-level features composed from the operators."""
