"""kestrel: Spark-native panel, time-series and document analytics.

Every public operator is a lazy ``DataFrame(s) + params -> DataFrame`` function.
"""

__version__ = "0.1.0"
