"""gleaner: crawled page snapshots to a relational catalogue, as Spark DataFrame jobs.

Subpackages: ``functions`` (Column scalars), ``sources`` (snapshots, selection CSV, charset
decode, sinks), ``operators`` (node table, selectors, sections, fields, requirements,
normalisation, integrity, views, skew-safe ordering), ``plans`` (the end-to-end batch plan and
the queries on the driver tables), ``streaming`` (incremental insert-if-absent ingest).
"""

__version__ = "0.1.0"
