"""A PySpark-native engine for noisy document text: geometry, records, consensus, evaluation and analytics."""
