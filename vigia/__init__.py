"""vigia: log and metric analytics for server fleets, written on Spark.

Every function takes and returns DataFrames.  Nothing is pulled to the driver
except where a result is printed or a benchmark line is written.
"""

__version__ = "0.1.0"
