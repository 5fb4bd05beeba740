"""Relational operators on ordered corpora."""
