"""meterqa: quality assurance of water-meter telemetry on Spark.

Every operator takes and returns DataFrames and handles all sites at once;
``site`` is a grouping key, never a loop variable.
"""
