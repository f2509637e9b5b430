"""Market analytics for large transaction and listing tables, on Spark."""
