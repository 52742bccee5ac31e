"""Operators on whole tables: zonal statistics, grids, audits, phenology, productivity, yield and scenes."""
