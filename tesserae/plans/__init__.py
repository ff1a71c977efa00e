"""Queries over the standard tables, each with its SQL."""
