"""meetloom: a PySpark-native engine for public-meeting documents and text corpora."""
