"""quayside: ingest, change-data, property-graph and load-metrics operators on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the public
DataFrame / SQL / Structured Streaming APIs, so the same code runs in batch and
in micro-batches.
"""

__version__ = "0.1.0"
