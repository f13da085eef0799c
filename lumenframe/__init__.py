"""Analytics operators over Spark DataFrames.

Every operator is a function ``DataFrame(s) -> DataFrame`` or a Spark ML stage.
"""
