"""Streaming sequence-analytics engine on PySpark: DataFrame in, DataFrame out."""
