"""cellstrand: Spark-native single-cell read analytics."""
