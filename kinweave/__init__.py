"""A batch entity-resolution engine on Spark DataFrames."""
