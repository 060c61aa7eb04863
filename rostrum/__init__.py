"""Parliamentary open-data analytics as Spark jobs."""
