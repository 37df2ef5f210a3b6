"""Compositions of operators: the read and write paths."""
