"""Operators put together: the four stages, and the query catalogue with its SQL twins."""
