"""A PySpark-native engine for preparing, measuring and validating mesh datasets."""
