"""Change feeds as queryable tables, and training-data operations, on Spark DataFrames."""
