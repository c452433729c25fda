"""Operators for preparing training text: one module each, queries in `queries`."""
