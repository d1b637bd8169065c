"""Operators of the lakehouse."""
