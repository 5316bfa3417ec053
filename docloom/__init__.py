"""docloom: corpus analytics and text classification as Spark DataFrame jobs."""
