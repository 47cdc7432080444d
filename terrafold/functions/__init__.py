"""Column functions: text, tags, geometry."""
