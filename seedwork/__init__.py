"""seedwork: a PySpark-native engine for pooled and low-coverage genotyping tables."""

__version__ = "0.1.0"
