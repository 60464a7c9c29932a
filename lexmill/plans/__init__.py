"""lexmill plans."""
