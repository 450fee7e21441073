"""Operators of a training-data pipeline: extraction, scans, filters, de-duplication, mixing, packing."""
