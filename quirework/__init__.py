"""Document-structure analytics as Spark DataFrames."""
