"""Asset pricing, ranking and scoring over Spark DataFrames."""
