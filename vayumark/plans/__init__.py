"""Operators put together: landing, building, auditing and reporting."""
