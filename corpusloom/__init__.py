"""A PySpark-native engine for book- and document-scale text corpora."""

__version__ = "0.1.0"
