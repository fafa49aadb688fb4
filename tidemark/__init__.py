"""Operators for daily-partitioned warehouses on PySpark."""
