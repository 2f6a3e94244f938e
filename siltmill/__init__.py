"""Spark-native preparation and auditing of instruction-tuning and training-text data."""
