"""feedlake: land record feeds in a Parquet lake and make them fit for analysis, on Spark.

Every operator is a function over DataFrames built from Spark DataFrame / SQL
expressions; nothing runs outside the Spark plan except a few driver-side
reads of metadata whose size is bounded by the number of streams or columns.
"""

__version__ = "0.1.0"
