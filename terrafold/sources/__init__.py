"""Readers: feature lines, element tables, staged parts, file listings."""
