"""Spark-native batch analytics over public-works spending records.

The subpackages are ``functions`` (column expressions), ``operators`` (DataFrame to DataFrame
transforms), ``sources`` (readers and sinks), ``plans`` (composed queries) and ``streaming``.
The optional subpackage ``llm`` holds text operators; nothing here imports it.
"""
