"""Spark-native earth-observation analytics: every operator is a DataFrame plan."""
