"""Real-time warehouse operators for PySpark: batch DataFrames and Structured Streaming."""

__version__ = "0.1.0"
