"""DataFrame jobs built from the column expressions."""
