"""Spark-native analytics for tiled detections."""
