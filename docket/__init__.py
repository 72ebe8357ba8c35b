"""Case-outcome analytics as Spark DataFrame and Spark ML jobs."""
