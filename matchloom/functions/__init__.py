"""Column functions: expressions only, no Python on the data path."""
