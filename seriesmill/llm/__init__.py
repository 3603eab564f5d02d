"""Operators for preparing training text: cleaning, duplicates, benchmarks, tokens, packing."""
