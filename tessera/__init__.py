"""tessera: text and road-graph analytics as composable Spark DataFrame plans.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst plans and optimises the work. Modules:

* ``tessera.sources``   -- readers (text lines, stop lists, key/value text,
  OSM XML, route queries, and adapters that derive corpora / ways / nodes
  from the driver's parquet tables)
* ``tessera.sinks``     -- text / XML writers
* ``tessera.functions`` -- column expressions (tokeniser, haversine,
  renderers)
* ``tessera.operators`` -- text, OSM, sequencing, graph and check operators
* ``tessera.plans``     -- composed jobs and the registered query catalog
* ``tessera.streaming`` -- Structured Streaming drivers for the same jobs
"""

__version__ = "0.1.0"
