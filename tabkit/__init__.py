"""tabkit: tabular data preparation, profiling and modelling on Spark DataFrames."""
