"""perfwatch: front-end performance analytics on Spark DataFrames.

Layers: ``functions`` (Column expressions), ``operators`` (DataFrame
transforms), ``sources`` (readers, sinks, driver-table adapters), ``plans``
(pipeline jobs and the query catalogue) and ``streaming`` (incremental
ingest).  No session is created here; callers run with
``spark.sql.session.timeZone=UTC``.
"""
__version__ = "0.1.0"
