"""riskloom: Spark-native risk scoring, evaluation and table monitoring."""

__version__ = "0.1.0"
