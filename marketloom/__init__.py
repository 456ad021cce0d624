"""Promotion analytics and training-data preparation as Spark DataFrame operators."""
