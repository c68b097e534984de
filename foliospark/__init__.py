"""foliospark: document evidence and corpus operators on Spark DataFrames."""
