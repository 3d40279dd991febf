"""Relational operators of entity resolution."""
