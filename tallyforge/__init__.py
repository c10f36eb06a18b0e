"""Spark-native operators for behaviour, survey, message and census analytics."""

__version__ = "0.1.0"
