"""A PySpark-native engine for evidence-grounded document and records analysis."""
