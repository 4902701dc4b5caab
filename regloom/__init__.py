"""Registry harmonisation and report mining as PySpark DataFrame jobs."""
