"""News-link credibility features, training and scoring, as Spark DataFrame jobs."""
