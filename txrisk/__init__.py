"""txrisk: Spark-native transaction-risk analytics.

Every operator takes and returns Spark DataFrames. Fitted state (winsor
bounds, scaler statistics, category lists) is kept as small parameter
tables so that it can be persisted and re-applied at scoring time.
"""

__version__ = "0.1.0"
