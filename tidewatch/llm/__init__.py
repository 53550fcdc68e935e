"""Operators for preparing training text: scanning, near duplicates, language, quality, packing and URL rules."""
