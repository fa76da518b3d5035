"""Operators that prepare training text: mixing, deduplication, filters, formatting and scans."""
