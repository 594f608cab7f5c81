"""Star-schema batch analytics on Spark: conform, model, load, check, ask."""
