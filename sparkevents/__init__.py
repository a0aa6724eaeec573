"""Spark-native normalization, encoding and routing of security-telemetry event streams."""

__version__ = "0.1.0"
