"""Spark-native engine for catalogue dumps and large training-data tables."""

__version__ = "0.1.0"
