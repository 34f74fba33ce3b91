"""Spark-native analytics: basket mining, recommendations and their validation."""
