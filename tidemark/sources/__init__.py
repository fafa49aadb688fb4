"""Landing files, their names, and static reference data."""
