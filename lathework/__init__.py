"""Spark-native curation and analysis of training datasets."""
