"""Relational operators: rules, deduplication, lookups, referential checks, keys and merges."""
