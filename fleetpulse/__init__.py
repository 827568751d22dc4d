"""Fleet telemetry and maintenance analytics on Spark.

``functions``  Column -> Column expressions
``operators``  DataFrame -> DataFrame steps
``sources``    schemas, readers, writers, keyed state, tables
``streaming``  Structured Streaming queries
``plans``      jobs built from the above, and the registered queries
"""
