"""Operators for preparing training text: cleaning, matching, de-duplication, tokens."""
