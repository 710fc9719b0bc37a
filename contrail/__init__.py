"""Position-report analytics as plain PySpark: DataFrame in, DataFrame out."""
