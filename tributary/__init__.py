"""Streaming and batch analytics operators for PySpark.

Every operator is a function from DataFrame to DataFrame.  Subpackages:
``sources`` (tables, files, messages), ``functions`` (column helpers),
``operators`` (joins, aggregates, windows, ranking, ordered scans, text),
``streaming`` (replay, keyed state, sinks, monitoring) and ``plans`` (the
registered queries with their SQL twins).
"""
