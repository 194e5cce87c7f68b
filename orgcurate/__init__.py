"""Spark-native operators for curating registries of organizations."""
