"""Column helpers and fixed text formats."""
