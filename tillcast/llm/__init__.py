"""Operators that prepare training text: packing, decontamination, filters, duplicates, scoring, personal data."""
