"""Spark-native engine that turns frame-level episode recordings into versioned training sets."""

__version__ = "0.1.0"
