"""Flight-delay features, models and metrics as Spark DataFrame jobs."""
