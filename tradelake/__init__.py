"""Spark-native analytics for trade data lakes."""
