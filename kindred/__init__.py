"""kindred: near-duplicate detection, grouping and exam assembly on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function or a
``Column -> Column`` expression built from ``pyspark.sql.functions``, so it
runs unchanged from ``local[*]`` to a cluster.  No operator creates a session.
"""

__version__ = "0.1.0"
