"""Golden records from overlapping sources, as Spark DataFrames."""
