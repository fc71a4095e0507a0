"""The operators bound to the given tables, and the same questions in SQL."""
