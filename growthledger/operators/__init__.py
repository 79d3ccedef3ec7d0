"""Reusable relational building blocks of the plans."""
