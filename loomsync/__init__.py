"""Table migration and record sync on Spark DataFrames."""

__version__ = "0.1.0"
