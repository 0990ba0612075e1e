"""leafwave: Spark-native GNSS transmissometry.

Observation tables are long DataFrames keyed by (receiver, epoch, sid); every
operator takes DataFrames and returns a lazy DataFrame.
"""

__version__ = "0.1.0"
