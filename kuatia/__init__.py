"""kuatia: a Spark-native engine for news-event analytics."""

__version__ = "0.1.0"
