"""wardstat: Spark-native analytics for wide, messy patient-level tables.

Every operator is a function ``fn(df, ...) -> DataFrame`` written with the
DataFrame / SQL / ML / Structured Streaming APIs; nothing runs on the driver
except plan construction and bounded statistics.
"""
__version__ = "0.1.0"
