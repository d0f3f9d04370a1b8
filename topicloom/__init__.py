"""Spark-native topic-emergence analytics."""
