"""quire: a PySpark-native engine for digitised-document collections."""

__version__ = "0.1.0"
