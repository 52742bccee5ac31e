"""Field time-series analytics on Spark: operators, sources, functions, plans and streaming twins."""
