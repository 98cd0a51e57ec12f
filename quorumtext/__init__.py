"""A PySpark-native engine for certainty-annotated text corpora."""
