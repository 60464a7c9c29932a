"""lexmill functions."""
