"""Operators for preparing training text: search for copies, filters, scores, extraction and packing."""
