"""Reading, validating, storing and exporting tables."""
