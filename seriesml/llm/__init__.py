"""Operators for preparing training text: scoring, filtering, deduplication, decontamination, tokens and packing."""
