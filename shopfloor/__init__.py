"""shopfloor: retail sales-event analytics as plain Spark DataFrame jobs.

Layers (each a set of pure ``DataFrame -> DataFrame`` builders):

* ``sources``   – table loading, raw sales lines, stream sources
* ``functions`` – column expressions (JSON repair, exact money, periods)
* ``operators`` – events, silver, star schema, reports, quality, profiling
* ``streaming`` – bronze ingest with Structured Streaming
* ``sinks``     – Parquet / JDBC writers
* ``plans``     – the end-to-end pipeline and the query catalog
"""

__version__ = "0.1.0"
