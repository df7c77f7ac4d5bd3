"""Environmental time-series integration and short-horizon forecasting on Spark.

Everything is a plain ``DataFrame -> DataFrame`` function that can be chained
with ``df.transform(...)``; see the package README for the operator map.
"""

__version__ = "0.1.0"
