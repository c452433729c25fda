"""Relational operators: ranking, merging, matching, search, quality."""
