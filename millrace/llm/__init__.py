"""Operators for preparing training text: quality, filters, mixing, tokens, near duplicates, models."""
