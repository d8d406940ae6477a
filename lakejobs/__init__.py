"""Spark-native batch and streaming jobs that feed and drain a data lake."""

__version__ = "0.1.0"
