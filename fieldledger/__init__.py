"""Field-service analytics as Spark DataFrame programs."""
