"""corvane: a PySpark-native engine for social-text corpora."""
