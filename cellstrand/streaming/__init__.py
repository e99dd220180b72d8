"""Continuous forms of operators."""
