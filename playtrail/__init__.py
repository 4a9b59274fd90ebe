"""Session analytics on user event tables, expressed in Spark DataFrames."""
