"""A PySpark-native engine for literature, registry and compound analytics."""
