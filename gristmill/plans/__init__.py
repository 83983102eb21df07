"""Whole stages put together from the operators."""
