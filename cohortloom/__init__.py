"""Account demand features, training and scoring as Spark jobs."""
