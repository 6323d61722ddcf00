"""Trip and activity analytics written as Spark DataFrame, SQL and Structured Streaming code."""

__version__ = "0.1.0"
