"""Question-and-answer community analytics on Spark DataFrames."""
