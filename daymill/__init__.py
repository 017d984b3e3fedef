"""Daily summaries and table movement on Spark."""
