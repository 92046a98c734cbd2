"""mailstream: a Spark-native pipeline for polled record feeds.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so that it runs unchanged in batch jobs and inside
Structured Streaming ``foreachBatch`` callbacks.
"""

__version__ = "0.1.0"
