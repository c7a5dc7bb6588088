"""strataflow: auditable corpus building on Spark DataFrames."""

__version__ = "0.1.0"
