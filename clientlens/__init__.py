"""Customer 360 analytics for retail banking, built on Spark DataFrames."""
