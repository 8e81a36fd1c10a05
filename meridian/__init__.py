"""meridian: review x weather star-schema analytics on Spark DataFrames.

Every job is a function from DataFrames to DataFrames; Catalyst plans and
AQE re-plans them. See README.md for the module map.
"""

__version__ = "0.1.0"
