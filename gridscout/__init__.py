"""Entity extraction, enrichment and ranked search as Spark jobs."""
