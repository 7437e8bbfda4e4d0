"""Product analytics, change ingestion, hybrid retrieval and telemetry jobs on Spark."""
