"""The pipeline's streaming jobs.

* word count: lines from a topic, counted per micro-batch (no state across
  batches), each batch's counts written idempotently;
* page routing: request URLs from a topic -> fetch (lookup join against
  landed responses) -> parcels -> keyed messages / dead letters;
* window totals: events per minute and micro-batch, added up on read;
* window probing: poll ticks -> lagged windows -> fetched count pages -> page
  requests, catch lane and recovery log;
* late lane: event-time totals with a watermark, late rows diverted.

All sources are file-backed topics here (no broker in tests); swapping in
the Kafka source changes only the reader (see ``sources.topics``).
Checkpoints and outputs live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.functions.time import iso_minute, minute_floor, minute_start
from mailstream.operators import messages as msg
from mailstream.operators import windows
from mailstream.operators import wordcount as wc
from mailstream.session import scratch_path
from mailstream.sources import topics
from mailstream.sources.fetch import fetch_lookup
from mailstream.streaming.sinks import (
    append_recovery_log, batch_dir, http_post, read_recovery_log, send_payloads, write_batch,
)

LINES_TOPIC = "lines"
# Rows in a file of a published topic log, at most.
ROWS_PER_FILE = 1_000_000


def publish(spark: SparkSession, msgs: DataFrame, topic: str) -> tuple[str, int]:
    """Write messages as an ordered, file-backed topic log; returns the
    folder and the files-per-trigger for its replay. A file holds at most
    ``ROWS_PER_FILE`` rows and a micro-batch a quarter as many files as the
    session has shuffle partitions, so more messages mean more batches, not
    larger ones."""
    path = scratch_path(spark, f"topic-{topic}")
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    topics.write_topics(msgs, path, files_per_topic=files, rows_per_file=ROWS_PER_FILE)
    return path, files // 4


def wordcount_query(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                    interval: str = "2 seconds", show_rows: int = 0):
    """Start the per-batch word count; returns the ``StreamingQuery``.
    ``show_rows`` also prints each batch's first rows (count desc, word) to
    the driver console, as the original print did; only those rows leave
    the executors."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = wc.wordcount(batch, "value")
        write_batch(counts, out_path, batch_id)
        if show_rows:
            wc.top_words(spark_read_batch(batch, out_path, batch_id), show_rows).show(show_rows, False)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def spark_read_batch(batch: DataFrame, out_path: str, batch_id: int) -> DataFrame:
    """A batch's written output (read back instead of recomputing it)."""
    return batch.sparkSession.read.parquet(batch_dir(out_path, batch_id))


def run_wordcount_stream(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Events become text messages on a file-backed topic (several files, so
    several micro-batches), the stream counts each batch, and the batch
    counts are summed back: equal to one count over all lines."""
    lines = events.select(F.lit(LINES_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"),
                          F.concat_ws(" ", "event_type", "props").alias("value"),
                          F.col("event_id").alias("seq"))
    topic_dir, per_batch = publish(spark, lines, LINES_TOPIC)
    stream = topics.read_topics(spark, topic_dir, LINES_TOPIC, streaming=True, files_per_batch=per_batch)
    out = scratch_path(spark, "wordcount-batches")
    q = wordcount_query(stream, out, scratch_path(spark, "wordcount-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).groupBy("word").agg(F.sum("count").alias("count"))


# Landed pages are stored partitioned by a hash bucket of the URL. There are so
# many buckets that each holds about this many pages, so a micro-batch reads
# files in proportion to its own URLs, however large the table is.
PAGES_PER_BUCKET = 32


def url_bucket(url, buckets: int) -> "F.Column":
    u = F.col(url) if isinstance(url, str) else url
    return F.pmod(F.xxhash64(u), F.lit(buckets)).cast("int")


def _layout(path: str) -> str:
    return f"{path.rstrip('/')}-layout"


def land_pages(pages: DataFrame, path: str, rows: int | None = None) -> int:
    """Write fetched/landed pages ``(url, status, body)`` partitioned by URL
    bucket; returns the number of buckets, which is kept beside the pages.
    ``rows`` is their number where it is known (about), else they are counted.
    A bucket is written by one task, so it is one file, and the hash placement
    needs no sampling pass over the pages."""
    spark = pages.sparkSession
    buckets = max(1, -(-(pages.count() if rows is None else rows) // PAGES_PER_BUCKET))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (pages.select("url", "status", "body").withColumn("url_bucket", url_bucket("url", buckets))
     .repartition(n, "url_bucket").write.partitionBy("url_bucket").parquet(path))
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(_layout(path))
    return buckets


def landed_for(spark: SparkSession, landed_path: str, requests: DataFrame) -> DataFrame:
    """The landed pages of the buckets that a batch's requests fall into: a
    partition filter on at most as many buckets as the batch has URLs."""
    buckets = spark.read.parquet(_layout(landed_path)).first()["buckets"]
    hit = [r[0] for r in requests.select(url_bucket("url", buckets).alias("b")).distinct().collect()]
    return spark.read.parquet(landed_path).filter(F.col("url_bucket").isin(hit))


def lookup_landed(spark: SparkSession, landed_path: str, requests: DataFrame) -> DataFrame:
    """Fetch by lookup for one batch of requests: only the buckets of its URLs
    are read, then the lookup join."""
    landed = landed_for(spark, landed_path, requests)
    return fetch_lookup(requests, landed.select("url", "status", "body"), status_col="status")


def route_query(stream: DataFrame, fetch: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                available_now: bool = True, interval: str = "60 seconds"):
    """Requests (``value`` = URL) -> ``fetch`` -> messages, per micro-batch.
    ``fetch`` turns ``(url)`` into ``(url, status, body)``: ``fetch_live``, or
    ``lookup_landed`` over a landed table. A URL requested several times in a
    batch is fetched once; its messages would be the same."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        fetched = fetch(batch.select(F.col("value").alias("url")).distinct())
        write_batch(msg.page_messages(fetched), out_path, batch_id)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_route_stream(spark: SparkSession, responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Land the responses ``(url, status, body)`` as a table, publish the
    requests, route the request stream, return every message."""
    landed_dir = scratch_path(spark, "landed-pages")
    land_pages(responses, landed_dir, rows=requests.count())
    reqs = requests.select(F.lit(msg.URLS_TOPIC).alias("topic"), F.lit("").alias("key"),
                       F.col("url").alias("value"))
    req_dir, per_batch = publish(spark, reqs, msg.URLS_TOPIC)
    stream = topics.read_topics(spark, req_dir, msg.URLS_TOPIC, streaming=True,
                                files_per_batch=per_batch)
    out = scratch_path(spark, "routed-batches")
    q = route_query(stream, lambda urls: lookup_landed(spark, landed_dir, urls), out,
                    scratch_path(spark, "route-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def batch_window_totals(events: DataFrame) -> DataFrame:
    """Count per 1-minute window of ``ts`` (UTC wall clock) in one batch: a
    map-side combine, no state."""
    minute = minute_floor("ts")
    end = F.col("m") + F.make_interval(mins=F.lit(1))
    return (events.filter(F.col("ts").isNotNull()).groupBy(minute.alias("m")).agg(F.count(F.lit(1)).alias("total"))
            .select(iso_minute("m").alias("start"), iso_minute(end).alias("end"), "total"))


def run_window_totals_stream(spark: SparkSession, events_path: str,
                             files_per_batch: int | None = None) -> DataFrame:
    """Each micro-batch writes its own counts per minute to its own batch
    folder (replay-safe); the view adds them up. Exact in any file order and
    however the files fall into batches: no watermark, so no row is late."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = scratch_path(spark, "window-totals")
    q = (reader.parquet(events_path).writeStream
         .foreachBatch(lambda batch, batch_id: write_batch(batch_window_totals(batch), out, batch_id))
         .option("checkpointLocation", scratch_path(spark, "window-totals-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return total_over_batches(spark, out)


def total_over_batches(spark: SparkSession, path: str) -> DataFrame:
    """Sum of every window's counts over the written batches."""
    return spark.read.parquet(path).groupBy("start", "end").agg(F.sum("total").alias("total"))


def window_router(ticks: DataFrame, totals: DataFrame, base_url: str | None = None) -> DataFrame:
    """Poll ticks (stream) -> the window each tick asks for -> its total
    (stream-static join on the window start) -> routed messages."""
    polls = windows.poll_windows(ticks).select("tick", "start", "end")
    joined = polls.join(totals.select("start", "total"), "start", "left")
    kw = {"base_url": base_url} if base_url else {}
    return msg.route_windows(joined, **kw)


def probe_query(ticks: DataFrame, fetch: Callable[[DataFrame], DataFrame], out_path: str, log_path: str, checkpoint: str,
                base_url: str | None = None, available_now: bool = True, interval: str = "60 seconds"):
    """Poll ticks (stream) -> the window each asks for -> its fetched count
    page -> messages, per micro-batch. The catch lane's request lines are also
    appended to the recovery log, from the batch as written, so a probe is
    fetched once. Both sinks are per batch and replay-safe."""
    kw = {"base_url": base_url} if base_url else {}

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        polls = windows.poll_windows(batch).select("start", "end").distinct()
        write_batch(msg.route_windows(msg.probe_windows(polls, fetch, **kw), **kw), out_path, batch_id)
        append_recovery_log(spark_read_batch(batch, out_path, batch_id), log_path, batch_id)

    w = ticks.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


RECOVERY = "recovery"


def run_probe_stream(spark: SparkSession, ticks: DataFrame, responses: DataFrame) -> DataFrame:
    """Replay a table of ticks through ``probe_query`` against landed count
    pages, in at least four batches; the messages, and the recovery log's lines
    as rows of topic ``recovery``."""
    landed, tick_dir = scratch_path(spark, "landed-counts"), scratch_path(spark, "ticks")
    responses.write.parquet(landed)
    ticks.repartition(max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))).write.option(
        "maxRecordsPerFile", ROWS_PER_FILE).parquet(tick_dir)
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    stream = spark.readStream.schema("tick timestamp_ntz").option("maxFilesPerTrigger", files).parquet(tick_dir)
    out, log = scratch_path(spark, "probed-batches"), scratch_path(spark, "recovery-log")
    probe_query(stream, lambda urls: fetch_lookup(urls, spark.read.parquet(landed), status_col="status"), out, log,
                scratch_path(spark, "probe-ckpt")).awaitTermination()
    lines = read_recovery_log(spark, log).select(F.lit(RECOVERY).alias("topic"), F.lit("").alias("key"), "value",
                                                 *[F.lit(None).cast("string").alias(c) for c in ("reason", "cause")])
    return spark.read.parquet(out).select("topic", "key", "value", "reason", "cause").union(lines)


def late_lane_query(events: DataFrame, out_path: str, checkpoint: str, lag_minutes: int = windows.LAG_MINUTES,
                    available_now: bool = True, interval: str = "60 seconds"):
    """Events (stream) -> totals per minute, with late rows in a lane of their
    own instead of being dropped. The watermark before a batch is the latest
    event time of all batches before it, less ``lag_minutes``; a row is late
    when its minute had ended by then. Each batch writes its latest time, its
    totals and its late rows to folders of its own: the state is the folder of the batch before,
    so a replayed or restarted batch sees the same watermark and writes the
    same rows. Rows without a time are late."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = batch_dir(f"{out_path}/clock", batch_id - 1)
        latest = spark.read.parquet(before).first()["latest"] if batch_id else None
        now = F.greatest(F.max("ts"), F.lit(latest).cast("timestamp_ntz"))      # skips nulls
        write_batch(batch.agg(now.alias("latest")), f"{out_path}/clock", batch_id)
        ended = minute_start("ts") + F.make_interval(mins=F.lit(windows.WINDOW_MINUTES))
        limit = F.lit(latest).cast("timestamp_ntz") - F.make_interval(mins=F.lit(lag_minutes))
        late = F.col("ts").isNull() | F.coalesce(ended <= limit, F.lit(False))
        write_batch(batch.filter(late), f"{out_path}/late", batch_id)
        write_batch(batch_window_totals(batch.filter(~late)), f"{out_path}/totals", batch_id)

    w = events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_late_lane_stream(spark: SparkSession, arrivals: DataFrame, batches: int) -> DataFrame:
    """``arrivals`` are events with the number of the ``batch`` (0..) they
    arrive in; each batch is landed as files of its own, in order. Returns
    ``(lane, start, event_id, total)``: on-time totals per minute and late rows."""
    landed, out = scratch_path(spark, "arrivals"), scratch_path(spark, "late-lane")
    cols = ["event_id", "ts"]
    staged = scratch_path(spark, "arrivals-staged")
    arrivals.select(*cols, "batch").repartition("batch").write.partitionBy("batch").parquet(staged)
    schema = arrivals.select(*cols).schema
    for b in range(batches):        # one small job a batch: the arrival order is the order of the files
        spark.read.parquet(staged).filter(F.col("batch") == b).select(*cols).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    late_lane_query(stream, out, scratch_path(spark, "late-lane-ckpt")).awaitTermination()
    return late_lane_view(spark, out)


def late_lane_view(spark: SparkSession, out_path: str) -> DataFrame:
    totals = total_over_batches(spark, f"{out_path}/totals")
    late = spark.read.parquet(f"{out_path}/late")
    return totals.select(F.lit("total").alias("lane"), "start", F.lit(None).cast("long").alias("event_id"), "total").union(
        late.select(F.lit("late"), iso_minute("ts"), "event_id", F.lit(1).cast("long")))


# Outcomes of a replayed request, and how often it is tried in all.
ANSWERED, AGAIN, GIVEN_UP = "answered", "again", "given_up"
MAX_ATTEMPTS = 3
LETTER_SCHEMA = "url string, reason string"


def replay_query(spark: SparkSession, letters_path: str, fetch: Callable[[DataFrame], DataFrame], out_path: str,
                 checkpoint: str, max_attempts: int = MAX_ATTEMPTS):
    """One pass over the dead letters that have come since the last one: each
    URL's page is asked for again, its parcels go out, and a failure becomes a
    new letter until it has been tried ``max_attempts`` times (the first
    request counts). ``fetch`` turns ``(url, attempt)`` into ``(url, status,
    body)``.

    Attempts are kept per URL in ``state``, one folder per batch, and a batch
    reads the folders before its own only: a replayed batch repeats itself. A
    URL that several letters name is asked for once a batch, and not any more
    once it is answered or given up, so it ends in one lane, once."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        urls = batch.select("url").distinct()
        tries = F.lit(1)
        if batch_id:
            state = spark.read.parquet(f"{out_path}/state").filter(F.col("batch_id") < batch_id)
            known = state.groupBy(F.col("url").alias("_u")).agg(F.max("attempts").alias("_n"),
                                                               F.max(F.col("outcome") != AGAIN).alias("_closed"))
            urls = urls.join(known, F.col("url") == F.col("_u"), "left").filter(~F.coalesce("_closed", F.lit(False)))
            tries = F.coalesce("_n", tries)
        todo_dir = f"{out_path}/todo"
        write_batch(urls.select("url", (tries + 1).alias("attempt")), todo_dir, batch_id)
        todo = spark.read.parquet(batch_dir(todo_dir, batch_id))
        write_batch(msg.page_messages(fetch(todo)), f"{out_path}/messages", batch_id)
        failed = (spark.read.parquet(batch_dir(f"{out_path}/messages", batch_id)).filter(F.col("topic") == msg.CATCH_URLS_TOPIC)
                  .select(F.col("url").alias("_u"), "reason"))
        outcome = F.when(F.col("_u").isNull(), ANSWERED).when(F.col("attempt") < max_attempts, AGAIN).otherwise(GIVEN_UP)
        write_batch(todo.join(failed, F.col("url") == F.col("_u"), "left").select(
            "url", F.col("attempt").alias("attempts"), outcome.alias("outcome"), "reason"), f"{out_path}/state", batch_id)
        done = spark.read.parquet(batch_dir(f"{out_path}/state", batch_id))
        write_batch(done.filter(F.col("outcome") == AGAIN).select("url", "reason"), letters_path, batch_id)

    letters = spark.readStream.schema(LETTER_SCHEMA).parquet(letters_path)
    return (letters.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


FINAL_TOPIC = "finalLane"


def replay_view(spark: SparkSession, out_path: str) -> DataFrame:
    """``(topic, key, value, reason, attempts)``: the parcels of answered
    requests and, on the final lane, the requests that were given up."""
    state = spark.read.parquet(f"{out_path}/state").select("url", "attempts", "outcome", F.col("reason").alias("why"))
    sent = spark.read.parquet(f"{out_path}/messages").filter(F.col("topic") == msg.PARCELS_TOPIC)
    sent = sent.join(state.filter(F.col("outcome") == ANSWERED), "url").select("topic", "key", "value", "reason", "attempts")
    lost = state.filter(F.col("outcome") == GIVEN_UP)
    return sent.union(lost.select(F.lit(FINAL_TOPIC), "url", "url", F.col("why"), "attempts"))


def run_replay_stream(spark: SparkSession, letters: DataFrame, fetch: Callable[[DataFrame], DataFrame],
                      max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Replay a dead-letter table ``(url, reason)`` until every request is
    answered or given up: a pass for each further attempt."""
    path, out, ckpt = (scratch_path(spark, f"replay-{n}") for n in ("letters", "out", "ckpt"))
    letters.select("url", "reason").write.parquet(f"{path}/batch_id=-1")
    for _ in range(max_attempts - 1):
        replay_query(spark, path, fetch, out, ckpt, max_attempts).awaitTermination()
    return replay_view(spark, out)


#: Parts of a batch that are delivered, and entered in the ledger, one by one.
DELIVERY_PARTS = 4
LEDGER_SCHEMA = "id long, status int, batch_id long, part int"


def post_query(spark: SparkSession, payloads: DataFrame, ledger_path: str, checkpoint: str, client=http_post,
               parts: int = DELIVERY_PARTS, available_now: bool = True, interval: str = "60 seconds"):
    """Payloads (stream of ``id, payload``) -> POST through ``client`` inside
    the tasks, with a ledger of what came of each delivery. A batch leaves out
    the ids that the ledger already has as delivered (status 2xx) and goes
    part by part (a hash of the id); a part's statuses are written before the
    next one starts. So a batch that failed half-way, run again, sends only the
    parts that are missing; refused ids are tried again when they come again.
    Repeated ids of a batch are sent once."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.dropDuplicates(["id"])
        fs = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
        for part in range(parts):
            mine = batch.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
            if fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
                known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
                done = known.filter((F.col("status").between(200, 299)) | ((F.col("batch_id") == batch_id) & (F.col("part") == part)))
                mine = mine.join(done.select("id").distinct(), "id", "left_anti")
            sent = send_payloads(mine, client)
            sent.write.mode("append").parquet(f"{batch_dir(ledger_path, batch_id)}/part={part}")

    w = payloads.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_post_stream(spark: SparkSession, payloads: DataFrame, client) -> DataFrame:
    """Every payload comes twice, the second time after the first log was
    worked off; ``(id, attempts, delivered)`` of each."""
    log, ledger, ckpt = (scratch_path(spark, f"post-{n}") for n in ("log", "ledger", "ckpt"))
    for _ in range(2):
        payloads.select("id", "payload").write.mode("append").parquet(log)
        stream = spark.readStream.schema("id long, payload string").parquet(log)
        post_query(spark, stream, ledger, ckpt, client).awaitTermination()
    return (spark.read.schema(LEDGER_SCHEMA).parquet(ledger).groupBy("id")
            .agg(F.count(F.lit(1)).alias("attempts"), F.max(F.col("status").between(200, 299)).alias("delivered")))


#: Minutes of a bounded clock in one micro-batch.
TICKS_PER_BATCH = 4096


def bounded_clock(spark: SparkSession, first_epoch: int, last_epoch: int, per_batch: int = TICKS_PER_BATCH) -> DataFrame:
    """The poll clock from one second to another, as a stream that ends."""
    from mailstream.sources.poller import TickSource, register_tick_source
    register_tick_source(spark)
    return (spark.readStream.format(TickSource.name()).option("intervalSeconds", 60 * windows.WINDOW_MINUTES)
            .option("originEpochSeconds", first_epoch).option("lastEpochSeconds", last_epoch).option("ticksPerBatch", per_batch).load())


def poll_query(ticks: DataFrame, out_path: str, checkpoint: str):
    """Ticks (stream) -> the window that each polls, per micro-batch."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(windows.poll_windows(batch).select("tick", "start", "end"), out_path, batch_id)

    return ticks.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).start()


def run_clock_stream(spark: SparkSession, events: DataFrame, per_batch: int = TICKS_PER_BATCH) -> DataFrame:
    """Replay the clock over the span of ``events``: one window a minute, from
    the first event's minute to the last one's."""
    epoch = lambda agg: F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), agg("ts"))
    first, last = events.agg(epoch(F.min), epoch(F.max)).first()
    out = scratch_path(spark, "clock-batches")
    q = poll_query(bounded_clock(spark, first, last, per_batch), out, scratch_path(spark, "clock-ckpt"))
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(out).drop("batch_id")
