"""Document-evidence analytics on PySpark: cases, pages, observations, decisions and scores as DataFrames."""
