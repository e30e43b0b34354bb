"""Reports built from several operators, and the catalogue of checked queries."""
