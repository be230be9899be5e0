"""strata: preparing, sampling, modelling and evaluating large labelled tables on Spark.

Every operator takes DataFrames and returns a DataFrame (or, for a fit, a Spark ML
model).  Nothing here creates a session; the caller owns it.
"""

__version__ = "0.1.0"
