"""Spark-native record linkage and skew-proof data processing."""
