"""Column expressions for names and numpy kernels for rasters."""
