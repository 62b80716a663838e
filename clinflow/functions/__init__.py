"""Column functions: JSON documents, web paths, times and small text fixes."""
