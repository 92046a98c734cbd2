"""Streaming = batch, restart from checkpoint, the tick-driven router."""

import time

from pyspark.sql import functions as F

from mailstream.operators import wordcount as wc
from mailstream.session import scratch_path
from mailstream.sources import topics
from mailstream.sources.poller import TickSource, _TickReader, tick_stream
from mailstream.sources.tables import table
from mailstream.streaming import jobs


def _batch_counts(events):
    text = events.select(F.concat_ws(" ", "event_type", "props").alias("value"))
    return {r["word"]: r["count"] for r in wc.wordcount(text, "value").collect()}


def test_stream_wordcount_equals_batch(spark, sf_small):
    ev = table(spark, sf_small, "events")
    got = {r["word"]: r["count"] for r in jobs.run_wordcount_stream(spark, ev).collect()}
    assert got == _batch_counts(ev)


def test_restart_no_loss_no_duplicates(spark, sf_small):
    ev = table(spark, sf_small, "events")
    topic_dir = scratch_path(spark, "t-restart-topic")
    msgs = ev.select(F.lit("lines").alias("topic"), F.lit(None).cast("string").alias("key"),
                     F.concat_ws(" ", "event_type", "props").alias("value"),
                     F.col("event_id").alias("seq"))
    topics.write_topics(msgs, topic_dir, files_per_topic=4)
    out, ckpt = scratch_path(spark, "t-restart-out"), scratch_path(spark, "t-restart-ckpt")

    def stream():
        return topics.read_topics(spark, topic_dir, "lines", streaming=True, files_per_batch=1)

    # first run: stop after the first micro-batch has committed
    q = (stream().writeStream.foreachBatch(
            lambda b, i: jobs.write_batch(wc.wordcount(b, "value"), out, i))
         .option("checkpointLocation", ckpt).trigger(processingTime="1 second").start())
    deadline = time.time() + 60
    while (q.lastProgress is None or q.lastProgress["batchId"] < 0) and time.time() < deadline:
        time.sleep(0.2)
    q.stop()
    done_first = spark.read.parquet(out).select("batch_id").distinct().count()
    assert done_first >= 1
    # restart from the same checkpoint and drain
    jobs.wordcount_query(stream(), out, ckpt).awaitTermination()
    got = spark.read.parquet(out).groupBy("word").agg(F.sum("count").alias("count"))
    assert {r["word"]: r["count"] for r in got.collect()} == _batch_counts(ev)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 4


def test_window_totals_stream_equals_batch(spark, sf_small):
    got = {(r["start"], r["total"]) for r in
           jobs.run_window_totals_stream(spark, f"{sf_small}/events*.parquet").collect()}
    ev = table(spark, sf_small, "events")
    from mailstream.functions.time import iso_minute, minute_floor
    want = {(r["s"], r["n"]) for r in
            ev.groupBy(iso_minute(minute_floor("ts")).alias("s")).agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_tick_driven_window_router(spark):
    # a deterministic clock: one tick per minute starting 2024-01-01T00:10Z
    start_ms = 1704067800000
    ticks = tick_stream(spark, 60_000, 1, start_ms)
    totals = spark.createDataFrame([("2024-01-01T00:04:00Z", 1500), ("2024-01-01T00:05:00Z", 0)],
                                   "start string, total long")
    routed = jobs.window_router(ticks, totals, "b?")
    out = scratch_path(spark, "t-router")
    q = (routed.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-router-ckpt"))
         .trigger(processingTime="100 milliseconds").start())
    deadline = time.time() + 60
    while time.time() < deadline:
        p = q.lastProgress
        if p is not None and p["batchId"] >= 2:
            break
        time.sleep(0.2)
    q.stop()
    rows = spark.read.parquet(out).collect()
    by_start = {}
    for r in rows:
        by_start.setdefault(r["start"], []).append((r["topic"], r["value"]))
    assert sorted(v for _, v in by_start["2024-01-01T00:04:00Z"]) == [
        "b?dateDebut=2024-01-01T00:04:00Z&dateFin=2024-01-01T00:05:00Z&startIndex=1&count=1000",
        "b?dateDebut=2024-01-01T00:04:00Z&dateFin=2024-01-01T00:05:00Z&startIndex=1001&count=1000"]
    assert by_start["2024-01-01T00:05:00Z"][0][0] == "catchingTopic"
    if "2024-01-01T00:06:00Z" in by_start:          # no total known: the catch lane, "failed"
        assert by_start["2024-01-01T00:06:00Z"][0][0] == "catchingTopic"


def test_tick_reader_offsets_are_absolute_minutes(monkeypatch):
    from mailstream.sources import poller
    now = [1704067200 + 30]
    monkeypatch.setattr(poller.time, "time", lambda: now[0])
    first = _TickReader({"intervalSeconds": "60"})
    rows, end = first.read(first.initialOffset())
    assert [x[0].isoformat() for x in rows] == ["2024-01-01T00:00:00"]
    # restarted 61 minutes later, without an origin: no gap, no repeat
    now[0] += 61 * 60
    again = _TickReader({"intervalSeconds": "60"})
    rows, upto = again.read(end)
    rows = [x[0].isoformat() for x in rows]
    assert len(rows) == 61 and rows[0] == "2024-01-01T00:01:00" and rows[-1] == "2024-01-01T01:01:00"
    assert [x[0].isoformat() for x in again.readBetweenOffsets(end, upto)] == rows
    assert list(again.read(upto)[0]) == []
    assert TickSource.name() == "poll_ticks"


def test_live_tick_source_emits_minute_grid(spark):
    from mailstream.sources.poller import register_tick_source

    register_tick_source(spark)
    origin = int(time.time()) - 300
    df = (spark.readStream.format("poll_ticks").option("intervalSeconds", "60")
          .option("originEpochSeconds", str(origin)).load())
    out = scratch_path(spark, "t-live-ticks")
    q = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-live-ticks-ckpt"))
         .trigger(processingTime="1 second").start())
    deadline = time.time() + 60
    while time.time() < deadline:
        p = q.lastProgress
        if p is not None and p.get("numInputRows", 0) > 0:
            break
        time.sleep(0.5)
    q.stop()
    assert q.exception() is None
    ticks = sorted(r["tick"] for r in spark.read.parquet(out).collect())
    assert len(ticks) >= 5
    steps = {(b - a).total_seconds() for a, b in zip(ticks, ticks[1:])}
    assert steps == {60.0}                               # consecutive minutes, none skipped
    assert all(t.second == 0 for t in ticks)


def test_wordcount_console_rows(spark, sf_small, capfd):
    ev = table(spark, sf_small, "events").limit(50)
    topic_dir = scratch_path(spark, "t-console-topic")
    topics.write_topics(ev.select(F.lit("lines").alias("topic"), F.lit(None).cast("string").alias("key"),
                                  F.col("event_type").alias("value"), F.col("event_id").alias("seq")),
                        topic_dir)
    stream = topics.read_topics(spark, topic_dir, "lines", streaming=True)
    q = jobs.wordcount_query(stream, scratch_path(spark, "t-console-out"),
                             scratch_path(spark, "t-console-ckpt"), show_rows=3)
    q.awaitTermination()
    assert "|word" in capfd.readouterr().out


def test_window_totals_stream_counts_every_row_in_any_order(spark):
    """Micro-batches in no time order touch the same minutes; every row counts,
    and an event without a time is in no window."""
    src = scratch_path(spark, "t-wt-src")
    import datetime as dt
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    m = lambda k: base + dt.timedelta(minutes=k)
    batches = [[(1, base), (2, base + dt.timedelta(seconds=30))], [(3, base + dt.timedelta(seconds=50)), (4, m(20))],
               [(5, m(17)), (6, m(1))], [(7, m(5)), (8, m(19)), (9, None)], [(10, m(-600)), (11, m(1))]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(e, t, 1, "view", 1.0, "") for e, t in rows], jobs.EVENTS_SCHEMA)
        df.coalesce(1).write.parquet(f"{src}/part={i}")
    got = {r["start"][11:16]: r["total"] for r in
           jobs.run_window_totals_stream(spark, f"{src}/part=*", files_per_batch=1).collect()}
    assert got == {"10:00": 3, "10:20": 1, "10:17": 1, "10:01": 2, "10:05": 1, "10:19": 1, "00:00": 1}


def test_landed_pages_file_count_is_bounded(spark, sf_small):
    """Each task writes one or two bucket folders: files stay within one
    per task plus one per bucket, and every page lands once."""
    import os

    from mailstream.plans.queries import rendered_pages
    pages = rendered_pages(spark, sf_small).select("url", "status", "body")
    out = scratch_path(spark, "t-landed")
    jobs.land_pages(pages, out)
    files = [f for _, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    buckets = [d for d in os.listdir(out) if d.startswith("url_bucket=")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= n + len(buckets)
    landed = spark.read.parquet(out)
    assert landed.count() == pages.count() == landed.select("url").distinct().count()


def _stop_after_first_batch(query):
    deadline = time.time() + 90
    while (query.lastProgress is None or query.lastProgress["batchId"] < 0) and time.time() < deadline:
        time.sleep(0.2)
    query.stop()


def test_probe_job_routes_three_lanes_and_logs_the_catch_lane(spark):
    """One fetch per probe; a batch run again replaces its messages and its
    lines in the recovery log."""
    import datetime as dt

    from mailstream.operators.paging import probe_url
    from mailstream.streaming.sinks import read_recovery_log
    t0 = dt.datetime(2031, 4, 1, 8, 0)
    said = {0: (200, "1500"), 1: (200, "0"), 2: (503, None), 3: (200, "cut"), 4: (200, None), 5: None, 6: (200, "-4")}
    minute = lambda k: (t0 + dt.timedelta(minutes=k)).strftime("%Y-%m-%dT%H:%M:00Z")
    rows = []
    for k, answer in said.items():
        if answer:
            total = answer[1]
            body = "<feed><a>" if total == "cut" else f"<feed>{f'<totalResults>{total}</totalResults>' if total else ''}</feed>"
            rows.append((minute(k), minute(k + 1), answer[0], body))
    pages = spark.createDataFrame(rows, "start string, end string, status int, body string").select(
        probe_url(F.col("start"), F.col("end"), "b?").alias("url"), "status", "body")
    ticks = spark.createDataFrame([(t0 + dt.timedelta(minutes=k + 6, seconds=k),) for k in said], "tick timestamp_ntz")
    src, out, log, ckpt = (scratch_path(spark, f"t-probe-{n}") for n in ("src", "out", "log", "ckpt"))
    ticks.repartition(7).write.parquet(src)
    fetch = lambda urls: jobs.fetch_lookup(urls, pages, status_col="status")
    stream = lambda: spark.readStream.schema("tick timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(src)
    _stop_after_first_batch(jobs.probe_query(stream(), fetch, out, log, ckpt, "b?", available_now=False, interval="1 second"))
    jobs.probe_query(stream(), fetch, out, log, ckpt, "b?").awaitTermination()
    got = spark.read.parquet(out).select("topic", "start", "value", "reason", "cause").collect()
    lanes = sorted((r["topic"], r["start"], r["reason"], r["cause"]) for r in got if r["topic"] == "catchingTopic")
    want = {1: ("empty", None), 2: ("failed", "http_503"), 3: ("failed", "parse_error"), 4: ("failed", "no_total"),
            5: ("failed", "http_404"), 6: ("failed", "no_total")}
    assert lanes == [("catchingTopic", minute(k), *want[k]) for k in sorted(want)]
    asked = sorted(r["value"] for r in got if r["topic"] == "urls")
    assert [u.split("startIndex=")[1] for u in asked] == ["1&count=1000", "1001&count=1000"]
    lines = sorted(r["value"] for r in read_recovery_log(spark, log).collect())
    assert lines == sorted(r["value"] for r in got if r["topic"] == "catchingTopic") and len(lines) == 6


def test_late_lane_holds_every_row_once_and_survives_a_restart(spark):
    """Totals and late rows against a plain loop over the batches, with a
    stop after the first of six batches; nothing is dropped."""
    import datetime as dt
    import random
    rnd, t0 = random.Random(2), dt.datetime(2031, 4, 1)
    rows = [(i, None if i % 97 == 0 else t0 + dt.timedelta(seconds=rnd.randrange(7200) + 1200 * (i % 6) - 3000 * (i % 11 == 0)), i % 6)
            for i in range(600)]
    src, out, ckpt = (scratch_path(spark, f"t-late-{n}") for n in ("src", "out", "ckpt"))
    schema = "event_id long, ts timestamp_ntz"
    for b in range(6):
        spark.createDataFrame([r[:2] for r in rows if r[2] == b], schema).coalesce(1).write.mode("append").parquet(src)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    _stop_after_first_batch(jobs.late_lane_query(stream(), out, ckpt, available_now=False, interval="1 second"))
    jobs.late_lane_query(stream(), out, ckpt).awaitTermination()
    latest, late, totals = None, set(), {}
    for b in range(6):
        mine = [r for r in rows if r[2] == b]
        for i, ts, _ in mine:
            m = ts and ts.replace(second=0)
            if ts is None or (latest and m + dt.timedelta(minutes=1) <= latest - dt.timedelta(minutes=5)):
                late.add(i)
            else:
                key = m.strftime("%Y-%m-%dT%H:%M:00Z")
                totals[key] = totals.get(key, 0) + 1
        latest = max([r[1] for r in mine if r[1]] + ([latest] if latest else []))
    got = jobs.late_lane_view(spark, out).collect()
    assert {r["event_id"] for r in got if r["lane"] == "late"} == late and len(late) > 20
    assert {r["start"]: r["total"] for r in got if r["lane"] == "total"} == totals
    assert sum(r["total"] for r in got) == len(rows)


def test_a_batch_reads_landed_files_in_proportion_to_its_urls(spark):
    seen = []
    for n in (300, 6000):
        path = scratch_path(spark, "t-landed")
        pages = spark.range(n).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.lit(200).alias("status"),
                                      F.lit("body").alias("body"))
        jobs.land_pages(pages, path)
        asked = spark.createDataFrame([("u3",), ("u77",), ("u250",), ("nowhere",)], "url string")
        files = jobs.landed_for(spark, path, asked).select(F.input_file_name()).distinct().count()
        seen.append((n // jobs.PAGES_PER_BUCKET, files))
        got = {r["url"]: r["status"] for r in jobs.lookup_landed(spark, path, asked).collect()}
        assert got == {"u3": 200, "u77": 200, "u250": 200, "nowhere": 404}
    assert all(files <= 4 for _, files in seen) and seen[1][0] > 10 * seen[0][0] > 40


def test_null_keys_spread_evenly_and_alike_on_replay(spark):
    from mailstream.operators.messages import assign_partition
    rows = spark.range(4000).select(F.col("id").alias("seq"), F.when(F.col("id") % 4 == 0, F.lit("k")).alias("key"), F.lit("v").alias("value"))
    first = {r["seq"]: r["partition"] for r in assign_partition(rows, 7, seq_col="seq").collect()}
    again = {r["seq"]: r["partition"] for r in assign_partition(rows.repartition(5, "seq"), 7, seq_col="seq").collect()}
    assert first == again and len({p for s, p in first.items() if s % 4 == 0}) == 1
    spread = [sum(1 for s, p in first.items() if s % 4 and p == k) for k in range(7)]
    assert max(spread) - min(spread) <= 3


def test_every_dead_letter_is_answered_or_given_up_once(spark):
    """Repeated letters for one URL, a page without parcels, one that answers
    at the third attempt, one that never does; each pass is a restart."""
    letters = spark.createDataFrame([("slow", "http_503"), ("slow", "http_503"), ("never", "http_500"), ("bare", "parse_error")],
                                    jobs.LETTER_SCHEMA)
    asked = []

    def fetch(todo):
        asked.extend((r["url"], r["attempt"]) for r in todo.collect())
        ok = (F.col("url") == "bare") | ((F.col("url") == "slow") & (F.col("attempt") == 3))
        return todo.select("url", F.when(ok, 200).otherwise(500).alias("status"), F.lit("<feed/>").alias("body"))

    got = [tuple(r) for r in jobs.run_replay_stream(spark, letters, fetch).collect()]
    assert got == [(jobs.FINAL_TOPIC, "never", "never", "http_500", 3)]
    assert sorted(set(asked)) == [("bare", 2), ("never", 2), ("never", 3), ("slow", 2), ("slow", 3)]


def test_a_delivery_that_failed_half_way_resends_only_the_rest(spark, tmp_path):
    """The transport breaks once at the third part; the parts before it are in
    the ledger and are not sent again. Refused ids are, when they come again."""
    import pytest
    broken, log = tmp_path / "broken", tmp_path / "sent"
    log.mkdir()

    def client(payloads):
        import os
        import uuid
        if len(payloads) and len(os.listdir(log)) >= 2 and not os.path.exists(broken):
            open(broken, "w").close()
            raise OSError("transport broke")
        (log / uuid.uuid4().hex).write_text(",".join(payloads))
        return [503 if p == "p5" else 200 for p in payloads]

    src, ledger, ckpt = (scratch_path(spark, f"t-post-{n}") for n in ("src", "ledger", "ckpt"))
    rows = spark.range(40).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"))
    rows.union(rows).coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema("id long, payload string").parquet(src)
    retries = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with pytest.raises(Exception, match="transport broke"):
            jobs.post_query(spark, stream(), ledger, ckpt, client).awaitTermination()
        first = sum(len(f.read_text().split(",")) for f in log.iterdir())
        assert 0 < first < 40
        jobs.post_query(spark, stream(), ledger, ckpt, client).awaitTermination()
        sent = [p for f in log.iterdir() for p in f.read_text().split(",")]
        assert sorted(sent) == sorted(f"p{i}" for i in range(40))
        rows.write.mode("append").parquet(src)
        jobs.post_query(spark, stream(), ledger, ckpt, client).awaitTermination()
        again = [p for f in log.iterdir() for p in f.read_text().split(",")]
        assert sorted(again) == sorted([*sent, "p5"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", retries)


def test_a_bounded_clock_restarts_without_a_gap(spark):
    first = 1_630_000_000
    last = first + 60 * 99
    out, ckpt = scratch_path(spark, "t-clock"), scratch_path(spark, "t-clock-ckpt")
    _stop_after_first_batch(jobs.poll_query(jobs.bounded_clock(spark, first, last, 7), out, ckpt))
    seen = spark.read.parquet(out).count()
    q = jobs.poll_query(jobs.bounded_clock(spark, first, last, 7), out, ckpt)
    q.processAllAvailable()
    q.stop()
    ticks = sorted(r["tick"] for r in spark.read.parquet(out).collect())
    assert 0 < seen and len(ticks) == len(set(ticks)) == 100
