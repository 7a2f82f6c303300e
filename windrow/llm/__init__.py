"""Operators for preparing training text: scoring, deduplication, classification, archives, tokens, packing."""
