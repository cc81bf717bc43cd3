"""loomset: a PySpark-native engine for curating chat-style training data."""
