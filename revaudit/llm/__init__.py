"""Operators for preparing training text: deduplication, filtering, tokens, mixing and licences."""
