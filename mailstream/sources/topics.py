"""Topics as sources and sinks.

Two backends behind one envelope ``(topic, key, value)``:

* ``kafka`` - the Spark Kafka connector (``subscribe`` takes the comma
  list; offsets live in the query checkpoint, not auto-committed);
* ``files`` - a parquet directory partitioned by ``topic``: the same
  envelope, readable as a batch or as a file stream. Used in tests and
  wherever no broker exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, key string, value string, partition int, seq long"


def topic_list(topics: str | list[str]) -> list[str]:
    """``"a,b"`` -> ``["a", "b"]`` (blank items dropped)."""
    items = topics.split(",") if isinstance(topics, str) else list(topics)
    return [t.strip() for t in items if t.strip()]


def kafka_source_options(bootstrap: str, topics: str | list[str], group_id: str | None = None,
                         starting: str = "latest", min_partitions: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``. Without a stored offset
    a new query starts at the newest message, like the original consumer."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topic_list(topics)),
            "startingOffsets": starting, "failOnDataLoss": "false"}
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def kafka_sink_options(bootstrap: str, acks: str = "1") -> dict[str, str]:
    """Options for ``writeStream.format("kafka")``; the frame carries
    ``topic``, ``key``, ``value`` and optionally ``partition``."""
    return {"kafka.bootstrap.servers": bootstrap, "kafka.acks": acks}


def read_topics(spark: SparkSession, path: str, topics: str | list[str],
                streaming: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Subscribe to ``topics`` of a file-backed topic directory; returns
    ``(topic, key, value)``. The topic filter is a partition filter, so
    unsubscribed topics are never read."""
    wanted = topic_list(topics)
    if streaming:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        df = reader.parquet(path)
    else:
        df = spark.read.schema(MESSAGE_SCHEMA).parquet(path)
    return df.filter(F.col("topic").isin(wanted)).select("topic", "key", "value")


def write_topics(msgs: DataFrame, path: str, files_per_topic: int | None = None,
                 order_col: str | None = None, rows_per_file: int | None = None) -> None:
    """Append messages to a file-backed topic directory. ``seq`` keeps the
    producer's order; ``files_per_topic`` splits each topic into several
    files (a file stream then reads them as successive batches), each of at
    most ``rows_per_file`` rows."""
    out = msgs
    if "partition" not in out.columns:
        out = out.withColumn("partition", F.lit(None).cast("int"))
    if "seq" not in out.columns:
        seq = F.col(order_col).cast("long") if order_col else F.monotonically_increasing_id()
        out = out.withColumn("seq", seq)
    out = out.select("topic", "key", "value", "partition", "seq")
    if files_per_topic:
        out = out.repartitionByRange(files_per_topic, "topic", "seq")
    writer = out.write.mode("append").partitionBy("topic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def events_as_messages(events: DataFrame) -> DataFrame:
    """The ``events`` table seen as a message log: ``event_type`` is the
    topic, the user the key, ``props`` the value, ``event_id`` the order."""
    return events.select(F.col("event_type").alias("topic"),
                         F.col("user_id").cast("string").alias("key"),
                         F.col("props").alias("value"),
                         F.col("event_id").alias("seq"), "ts")


def topic_scan(messages: DataFrame, topics: str | list[str]) -> DataFrame:
    """Batch subscription over an envelope frame: filter by the topic list
    and project the value as text."""
    return (messages.filter(F.col("topic").isin(topic_list(topics)))
            .select("topic", "key", F.col("value").cast("string").alias("value")))
