"""SQL table functions."""
