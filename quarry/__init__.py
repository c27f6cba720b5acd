"""quarry — text, table and graph mining operators on Spark DataFrames."""

__version__ = "0.1.0"
