"""Bulk record import, de-duplication, synchronisation and search on Spark.

Every operator takes and returns a DataFrame (or Column) and leaves the physical
plan to Spark.
"""
