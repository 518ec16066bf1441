"""Trip and request-trace analytics on PySpark DataFrames."""
