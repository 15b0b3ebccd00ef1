"""Market-data analytics on Spark: ticks -> bars -> indicators -> star schema -> forecasts.

Every operator is a lazy ``DataFrame -> DataFrame`` function; actions happen only in
``plans`` (batch jobs) and ``streaming`` (Structured Streaming jobs).
"""
