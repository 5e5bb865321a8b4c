"""frostline: a Spark-native toolkit that turns a clinical "data freeze" of CSV
files into a typed, documented warehouse with curated and metadata views."""

__version__ = "0.1.0"
