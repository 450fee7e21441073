"""Readers: JSON-lines folders, tables, message logs."""
