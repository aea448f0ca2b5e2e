"""Social post and news feed analytics as Spark DataFrame jobs."""
