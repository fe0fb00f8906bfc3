"""tidemark: subscriber-event analytics on Spark.

Layers: ``sources`` (fixtures, landing scans, table store), ``operators``
(ingest, quality, silver, gold, features, scoring, drift, model metrics,
warehouse, KPIs), ``functions`` (column rules), ``plans`` (pipeline runs,
query catalogue) and ``streaming`` (Structured Streaming ingest and silver).
"""

__version__ = "0.1.0"
