"""Plain SQL for DuckDB that states what every registered query must return."""
