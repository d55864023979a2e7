"""Column functions; all are built from native expressions."""
