"""Column functions: NULL-safe arithmetic, spectral and radar indices, calendars, grids, geometry, text and crop rules."""
