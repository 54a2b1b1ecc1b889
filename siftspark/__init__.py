"""siftspark: a PySpark-native engine for curating catalogues and text corpora."""

__version__ = "0.1.0"
