"""Spark-native analytics over news-style article records and the names they mention."""
