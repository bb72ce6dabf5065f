"""A PySpark-native engine for structured regulatory text."""
