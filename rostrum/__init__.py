"""rostrum: a Spark-native engine for timed text corpora."""

__version__ = "0.1.0"
