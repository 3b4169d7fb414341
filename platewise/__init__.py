"""Food-delivery marketplace analytics as PySpark DataFrame jobs."""
