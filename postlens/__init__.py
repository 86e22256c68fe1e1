"""postlens: Spark-native analytics for social-media post captures."""

__version__ = "0.1.0"
