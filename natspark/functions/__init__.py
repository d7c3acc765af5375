"""Column functions: addresses, times, names."""
