"""riskframe: a Spark-native toolkit for scoring rare events in large tables and streams."""

__version__ = "0.1.0"
