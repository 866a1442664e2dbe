"""Operators for preparing training data: formatting, mixing, token files, filtering, deduplication, search, packing."""
