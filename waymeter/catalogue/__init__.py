"""Every query by name, on the shared parquet tables, with its SQL statement for comparison."""
