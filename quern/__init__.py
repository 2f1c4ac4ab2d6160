"""A PySpark-native engine for evidence-backed entity analytics."""
