"""Operators for cleaning, searching and mixing training text."""
