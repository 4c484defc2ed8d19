"""loanlake: loan-servicing analytics on Spark.

Subpackages: ``sources`` (fixtures, landing files, message bus), ``functions``
(Column builders), ``operators`` (staging, windows, marts, merge, stats,
incremental, state, quality, history), ``plans`` (registered queries,
pipeline, tables, views), ``streaming`` (Structured Streaming ingest).
"""

__version__ = "0.1.0"
