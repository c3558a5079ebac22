"""postloom: a Spark-native engine for mail archives and text corpora."""

__version__ = "0.1.0"
