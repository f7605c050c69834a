"""Spark-native analytics for gridded observations, segmented objects and labelled feature vectors."""
