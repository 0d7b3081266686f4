"""Vigie: rescue-operations analytics as Spark DataFrame plans."""
