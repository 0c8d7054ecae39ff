"""Star-schema warehouse building, checking and metrics on Spark DataFrames."""
