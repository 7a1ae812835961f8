"""lakeops: Spark operators for monthly trip-record lakehouses.

Land raw monthly files, conform drifting service schemas to one typed table,
audit it, repair what can be repaired, replace month partitions, and build
additive hourly metrics. Every operator is a lazy DataFrame function.
"""

__version__ = "0.1.0"
