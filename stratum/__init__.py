"""Three-layer retail analytics on Spark: landing files -> raw -> conformed -> marts."""
