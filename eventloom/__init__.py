"""News-event and knowledge-graph analytics as Spark DataFrame jobs."""
