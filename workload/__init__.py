"""Queries over the given tables, and the same in SQL for comparison."""
