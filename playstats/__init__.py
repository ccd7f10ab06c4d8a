"""Spark-native listening-history analytics.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (named
queries and their DuckDB oracles), ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
