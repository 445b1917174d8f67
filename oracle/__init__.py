"""Independent SQL statements for the registered queries."""
