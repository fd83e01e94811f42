"""Market feature and corpus analytics on Spark."""
