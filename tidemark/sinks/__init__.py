"""Partition-replacing table writes."""
