"""courtstats: basketball analytics as Spark DataFrame operators and plans."""

__version__ = "0.1.0"
