"""Operators that prepare training text: deduplication, search, packing, counting, mixing, labels and scans."""
