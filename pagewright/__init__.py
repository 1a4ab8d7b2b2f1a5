"""Spark-native processing of scanned and digital page collections."""
