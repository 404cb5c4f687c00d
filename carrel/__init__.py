"""Library and archive data jobs as Spark DataFrames."""
