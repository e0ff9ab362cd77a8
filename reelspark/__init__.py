"""Movie-catalogue analytics expressed as Spark DataFrame jobs."""
