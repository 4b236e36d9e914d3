"""A PySpark-native engine for the analysis and quality control of document corpora."""
