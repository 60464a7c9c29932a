"""lexmill streaming."""
