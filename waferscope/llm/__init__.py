"""Operators for preparing training data: deduplication, filters, formatting, counting and packing."""
