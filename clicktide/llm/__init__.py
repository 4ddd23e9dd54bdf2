"""Operators for preparing training text: filters, de-duplication, packing, sharding."""
