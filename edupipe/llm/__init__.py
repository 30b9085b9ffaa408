"""Operators for preparing training text: deduplication, decontamination, tokenization, packing."""
