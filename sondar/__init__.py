"""sondar: a Spark-native engine for crawled-page evidence, truth tables and training-data preparation."""

__version__ = "0.1.0"
