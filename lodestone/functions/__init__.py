"""Column functions; see text."""
