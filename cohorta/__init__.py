"""Time-partitioned scoring, evaluation and monitoring as Spark jobs."""
