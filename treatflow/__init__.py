"""Land-treatment record processing on Spark DataFrames."""
