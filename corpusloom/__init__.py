"""A PySpark-native engine for mining, scoring and curating text corpora."""
