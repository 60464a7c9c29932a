"""lexmill operators."""
