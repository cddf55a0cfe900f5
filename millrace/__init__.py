"""Data-pipeline and analytics operators written as Spark DataFrame functions."""
