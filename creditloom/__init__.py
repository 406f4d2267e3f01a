"""Credit-scoring analytics expressed as Spark DataFrame jobs."""
