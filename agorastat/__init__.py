"""Analytics for community question-and-answer dumps on Apache Spark."""
