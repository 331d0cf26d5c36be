"""Column functions; every one is a built-in expression, none calls Python per row."""
