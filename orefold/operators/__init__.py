"""Table-to-table steps."""
