"""batchgate: admit batches of semi-structured field sheets into a curated history, on Spark.

Every operator is a function from DataFrames to a DataFrame.  Nothing here collects rows, and no
operator runs Python per row: the work is declared with built-in functions and planned by Catalyst.
"""

__version__ = "0.1.0"
