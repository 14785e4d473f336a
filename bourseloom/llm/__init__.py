"""Operators for preparing training text: packing, mixing, joins, fingerprints, filters, search."""
