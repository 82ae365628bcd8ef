"""Word-puzzle analytics on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame; nothing is
collected to the driver except metadata of bounded size (partition values,
model parameters, one-row gates).
"""
