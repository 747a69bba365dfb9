"""factsieve: a PySpark-native engine for auditing, merging and scoring document facts."""

__version__ = "0.1.0"
