"""Laboratory-result analytics as PySpark DataFrame operators."""
