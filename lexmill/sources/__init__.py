"""lexmill sources."""
