"""forumlens: Spark-native analytics over large archives of forum posts."""

__version__ = "0.1.0"
