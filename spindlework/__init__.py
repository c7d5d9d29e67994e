"""Machine monitoring and failure classification on PySpark DataFrames."""
