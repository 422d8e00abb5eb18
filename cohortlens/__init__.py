"""cohortlens: member engagement and drop-out risk analytics on Spark.

Every step is a DataFrame -> DataFrame function over Spark's own
expressions; see README.md for the operator map.
"""

__version__ = "0.1.0"
