"""Daily retail sales analytics as Spark DataFrame functions."""
