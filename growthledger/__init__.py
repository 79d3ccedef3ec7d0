"""Growth-accounting analytics over user-event data, built on Spark DataFrames."""
