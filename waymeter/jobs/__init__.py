"""Applications for spark-submit."""
