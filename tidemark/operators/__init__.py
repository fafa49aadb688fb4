"""Relational operators; all take column names and work on any DataFrame."""
