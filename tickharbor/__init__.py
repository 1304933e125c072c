"""Tick lakehouse analytics on PySpark.

The same DataFrame operators serve batch and streaming input:

* ``tickharbor.sources``    scans: tick lake, file inventory, Kafka / file streams
* ``tickharbor.functions``  column-level building blocks: JSON parsing, time, partition predicates
* ``tickharbor.operators``  aggregates, windows, top-k, inventories, quality checks, sinks, compaction
* ``tickharbor.streaming``  exactly-once ingest, event-time windows, continuously refreshed newest rows
* ``tickharbor.plans``      whole jobs: verified compaction, the merged tick view, registered queries
"""

__version__ = "0.1.0"
