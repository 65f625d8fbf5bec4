"""Spark-native analytics over a shared file store: versions, folder trees, activity, matching and quality."""
