"""boxlake: a PySpark-native engine for object-detection data and training-data preparation."""

__version__ = "0.1.0"
