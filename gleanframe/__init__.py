"""A Spark-native engine for auditable document metrics."""
