"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them: the Atom
pages rendered from orders/lineitem, the topic logs written from events)
and runs whole tables through the library's operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.functions.text import java_hash, pmod_partition
from mailstream.functions.time import iso_minute, iso_second, minute_floor
from mailstream.operators import feed as feedops
from mailstream.operators import messages as msg
from mailstream.operators import paging, parcels as P, windows, wordcount as wc
from mailstream.plans import count_fixture
from mailstream.plans.atom_fixture import page_index, render_pages
from mailstream.sources import lines, topics
from mailstream.sources.fetch import fetch_lookup
from mailstream.sources.tables import table

BASE_URL = paging.DEFAULT_BASE_URL
SUBSCRIBED = "click,view,purchase"
PARTITIONS = 8
# Added to a page's URL: requests without a response, with an error status,
# and with a body that is not well-formed.
MISS_SUFFIX, BUSY_SUFFIX, BROKEN_SUFFIX = "&retry=1", "&retry=2", "&retry=3"
BROKEN_BODY = "<feed><entry><id>cut off"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


def _t(spark, sf, name):
    return table(spark, sf, name)


# -- word count --------------------------------------------------------------

@query
def q_wordcount(spark, sf):
    return wc.wordcount(_t(spark, sf, "documents").select("text"), "text")


@query
def q_wordcount_top10(spark, sf):
    return wc.top_words(q_wordcount(spark, sf), 10)


@query
def q_wordcount_by_interval(spark, sf):
    ev = _t(spark, sf, "events").select("ts", "event_type")
    out = wc.wordcount_by_interval(ev, "ts", "event_type", 2)
    return out.select(iso_second("batch_start").alias("batch_start"), "word", "count")


@query
def q_line_scan(spark, sf):
    return lines.explode_lines(_t(spark, sf, "documents"), "text", keep=("doc_id",))


@query
def q_topic_scan(spark, sf):
    return topics.topic_scan(topics.events_as_messages(_t(spark, sf, "events")), SUBSCRIBED)


# -- polling windows and paging ---------------------------------------------

@query
def q_poll_windows(spark, sf):
    ticks = windows.clock_ticks(_t(spark, sf, "events").select("ts"))
    return windows.poll_windows(ticks).select("tick", "start", "end")


@query
def q_probe_urls(spark, sf):
    pw = q_poll_windows(spark, sf)
    return pw.select("start", "end", paging.probe_url(F.col("start"), F.col("end"), BASE_URL).alias("url"))


@query
def q_window_totals(spark, sf):
    return windows.window_totals(_t(spark, sf, "events").select("ts")).select("start", "end", "total")


@query
def q_route_windows(spark, sf):
    totals = q_window_totals(spark, sf)
    return msg.route_windows(totals, BASE_URL).select("topic", "key", "value", "reason")


@query
def q_probe_route(spark, sf):
    """Every window of the polled span: count probe, fetched count page, then
    its page requests or its place on the catch lane."""
    ev = _t(spark, sf, "events").select("ts")
    polls = windows.poll_windows(count_fixture.poll_ticks(ev)).select("start", "end")
    pages = count_fixture.count_pages(ev, BASE_URL)
    probed = msg.probe_windows(polls, lambda urls: fetch_lookup(urls, pages, status_col="status"), BASE_URL)
    return msg.route_windows(probed, BASE_URL).select("topic", "key", "value", "reason", "cause")


def _flag_probes(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate")
    return (li.groupBy("l_returnflag", "l_linestatus")
              .agg(iso_minute(F.min("l_shipdate")).alias("start"),
                   iso_minute(F.max("l_shipdate")).alias("end"),
                   F.count(F.lit(1)).alias("total")))


@query
def q_page_plan(spark, sf):
    return paging.page_plan(_flag_probes(spark, sf), "total", paging.STEP, inclusive=True)


@query
def q_page_plan_exclusive(spark, sf):
    return paging.page_plan(_flag_probes(spark, sf), "total", paging.STEP, inclusive=False)


@query
def q_page_urls(spark, sf):
    plan = q_page_plan(spark, sf)
    return paging.page_urls(plan, BASE_URL).select("l_returnflag", "l_linestatus", "start_index", "url")


@query
def q_page_slices(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey")
    return paging.page_slices(orders, ["o_orderkey"], paging.STEP)


# -- fetch -------------------------------------------------------------------

@query
def q_fetch_lookup(spark, sf):
    pages = _t(spark, sf, "pages").select("url", "html")
    requests = pages.select("url").unionByName(
        pages.select(F.concat("url", F.lit("#missing")).alias("url")))
    return fetch_lookup(requests, pages, body_col="html").select("url", "status", "body")


# -- Atom round trip ---------------------------------------------------------

def rendered_pages(spark, sf) -> DataFrame:
    return render_pages(_t(spark, sf, "orders"), _t(spark, sf, "lineitem"),
                        _t(spark, sf, "customer"), _t(spark, sf, "nation"), BASE_URL)


def _page_urls(spark, sf) -> DataFrame:
    """Every rendered page's URL, from the orders alone (the pages are not
    rendered to list them)."""
    return page_index(_t(spark, sf, "orders"), BASE_URL).select("url")


def page_requests(spark, sf) -> DataFrame:
    """Every page's URL and, for each, three that fail in their own way."""
    suffixes = F.array(*[F.lit(s) for s in ("", MISS_SUFFIX, BUSY_SUFFIX, BROKEN_SUFFIX)])
    return (_page_urls(spark, sf).withColumn("_s", F.explode(suffixes))
            .select(F.concat("url", "_s").alias("url")))


def page_responses(spark, sf) -> DataFrame:
    """``(url, status, body)``: the rendered pages, and for each a refused and
    a broken response."""
    urls = _page_urls(spark, sf)
    busy = urls.select(F.concat("url", F.lit(BUSY_SUFFIX)).alias("url"), F.lit(503).alias("status"),
                       F.lit("busy").alias("body"))
    broken = urls.select(F.concat("url", F.lit(BROKEN_SUFFIX)).alias("url"), F.lit(200).alias("status"),
                         F.lit(BROKEN_BODY).alias("body"))
    return rendered_pages(spark, sf).select("url", "status", "body").unionByName(busy).unionByName(broken)


def _entries(spark, sf) -> DataFrame:
    return P.entries(rendered_pages(spark, sf).select("url", "body"), texts=True)


def _key_entries(spark, sf, schema=feedops.KEY_ENTRY, spans=None) -> DataFrame:
    """Entries parsed with a pruned schema (ids, step dates, addresses, or less)."""
    return P.key_entries(rendered_pages(spark, sf).select("url", "body"), schema=schema, spans=spans)


def fetched_round_trip(spark, sf) -> DataFrame:
    """All requests, fetched with the lookup join."""
    return fetch_lookup(page_requests(spark, sf), page_responses(spark, sf), status_col="status")


@query
def q_feed_total(spark, sf):
    parsed = feedops.parse_feed(rendered_pages(spark, sf).select("url", "body"), feedops.COUNT_ENTRY)
    return parsed.select("url", "total_results", F.size("entries").alias("n_entries"))


@query
def q_entry_positions(spark, sf):
    e = _key_entries(spark, sf, feedops.TITLE_ENTRY)
    return e.select("url", "entry_pos",
                    feedops.first_by_class(F.col("entry.title.div.span"), "id").alias("isie"))


@query
def q_machine_parcels(spark, sf):
    return P.machine_parcels(_entries(spark, sf))


@query
def q_manual_parcels(spark, sf):
    return P.manual_parcels(_entries(spark, sf))


PARCEL_COLS = ["url", "entry_pos", "kind", "li_pos", *P.PARCEL_FIELDS, "id"]


@query
def q_parcels(spark, sf):
    return P.parcels(_entries(spark, sf)).select(*PARCEL_COLS)


@query
def q_parcel_keys(spark, sf):
    return P.with_keys(P.step_keys(_key_entries(spark, sf, spans=P.KEY_SPANS))).select("url", "entry_pos", "kind", "li_pos", "key")


@query
def q_parcels_last(spark, sf):
    keyed = P.with_keys(P.step_keys(_key_entries(spark, sf, spans=P.KEY_SPANS)))
    # project first: only the key and its document position cross the shuffle
    narrow = keyed.select("url", "key", "entry_pos", "kind", "li_pos")
    return P.last_per_key(narrow).select("url", "key", "entry_pos", "kind", "li_pos")


@query
def q_treatment_counts(spark, sf):
    return P.treatment_counts(_key_entries(spark, sf, feedops.LIST_ENTRY))


@query
def q_addresses(spark, sf):
    return P.addresses(_key_entries(spark, sf, spans=P.ADDRESS_SPANS))


@query
def q_blank_to_null(spark, sf):
    p = P.parcels(_entries(spark, sf))
    return p.select("url", "entry_pos", "kind", "li_pos", "isie", "updated", "published",
                    F.col("machine.debutTraitement").alias("debutTraitement"),
                    F.col("manuel.date").alias("date"),
                    F.col("id").alias("datePublication"))


@query
def q_parcel_json(spark, sf):
    p = P.with_keys(P.parcels(_entries(spark, sf)))
    return p.select("url", "entry_pos", "kind", "li_pos", "key", P.parcel_json(p).alias("value"))


@query
def q_route_pages(spark, sf):
    return msg.page_messages(fetched_round_trip(spark, sf)).select("topic", "key", "value", "reason")


@query
def q_replay_dead_letters(spark, sf):
    routed = msg.page_messages(fetched_round_trip(spark, sf), failed_only=True)
    return msg.replay_dead_letters(routed).select("topic", "key", "value", "retry_reason")


@query
def q_egress_messages(spark, sf):
    m = msg.page_messages(fetched_round_trip(spark, sf))
    return msg.assign_partition(m, PARTITIONS).select("topic", "key", "value", "partition")


@query
def q_map_explode(spark, sf):
    kv = msg.page_messages(fetched_round_trip(spark, sf)).filter(F.col("topic") == msg.PARCELS_TOPIC)
    return msg.explode_result_map(msg.page_result_map(kv.select("url", "key", "value")))


# -- keys, payloads, logs ----------------------------------------------------

@query
def q_partition_assign(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    return c.select("c_custkey", F.col("c_name").alias("key"),
                    java_hash("c_name").alias("hash"),
                    pmod_partition("c_name", PARTITIONS).alias("partition"))


@query
def q_null_key_lane(spark, sf):
    """The event log with every third message without a key."""
    log = topics.events_as_messages(_t(spark, sf, "events"))
    keyed = log.withColumn("key", F.when(F.col("seq") % 3 != 0, F.col("key")))
    return msg.assign_partition(keyed, PARTITIONS, seq_col="seq").select("topic", "seq", "key", "value", "partition")


@query
def q_post_payload(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return msg.post_payload(ev, "event_id", "event_type", "value", "value", "props").select("id", "payload")


@query
def q_late_rows(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "ts")
    published = F.col("ts") + F.make_interval(mins=(F.col("event_id") % 11).cast("int"))
    late = windows.late_rows(ev.withColumn("published", published), "published")
    m = minute_floor("ts")
    return late.select("event_id", iso_minute(m).alias("window_start"),
                       iso_minute(m + F.make_interval(mins=F.lit(6))).alias("polled_at"),
                       iso_second("published").alias("published_at"))


@query
def q_recovery_log(spark, sf):
    from mailstream.streaming.sinks import append_recovery_log, read_recovery_log
    from mailstream.session import scratch_path
    routed = msg.route_windows(q_window_totals(spark, sf), BASE_URL)
    path = scratch_path(spark, "recovery-log")
    append_recovery_log(routed, path, batch_id=0)
    return read_recovery_log(spark, path)


# -- streaming ---------------------------------------------------------------

@query
def q_stream_wordcount(spark, sf):
    from mailstream.streaming.jobs import run_wordcount_stream
    return run_wordcount_stream(spark, _t(spark, sf, "events"))


@query
def q_stream_route(spark, sf):
    from mailstream.streaming.jobs import run_route_stream
    return run_route_stream(spark, page_responses(spark, sf), page_requests(spark, sf)).select("topic", "key", "value", "reason")


@query
def q_stream_window_totals(spark, sf):
    from mailstream.session import scratch_path
    from mailstream.streaming.jobs import run_window_totals_stream
    landed = scratch_path(spark, "events-landed")
    # at least eight files, in no time order, two a batch: the number of
    # batches grows with the table, their size does not
    events = _t(spark, sf, "events")
    events.repartition(max(8, len(events.inputFiles()))).write.parquet(landed)
    return run_window_totals_stream(spark, landed, files_per_batch=2)


@query
def q_stream_probe_route(spark, sf):
    from mailstream.streaming.jobs import run_probe_stream
    ev = _t(spark, sf, "events").select("ts")
    return run_probe_stream(spark, count_fixture.poll_ticks(ev), count_fixture.count_pages(ev, BASE_URL))


ARRIVAL_BATCHES = 12


@query
def q_stream_late_lane(spark, sf):
    """Events arrive up to ten hours late, in twelve batches of equal time."""
    from mailstream.streaming.jobs import run_late_lane_stream
    ev = _t(spark, sf, "events").select("event_id", "ts")
    came = ev.withColumn("_at", F.col("ts") + F.make_interval(hours=(F.col("event_id") % 11).cast("int")))
    lo, hi = came.agg(F.min("_at"), F.max("_at")).first()
    since = lambda t: F.timestamp_diff("SECOND", F.lit(lo).cast("timestamp_ntz"), t)
    length = F.greatest(since(F.lit(hi).cast("timestamp_ntz")), F.lit(1))
    batch = F.least(F.floor(since(F.col("_at")) * ARRIVAL_BATCHES / length), F.lit(ARRIVAL_BATCHES - 1))
    arrivals = came.select("event_id", "ts", batch.cast("int").alias("batch"))
    return run_late_lane_stream(spark, arrivals, ARRIVAL_BATCHES)


@query
def q_stream_clock(spark, sf):
    from mailstream.streaming.jobs import run_clock_stream
    return run_clock_stream(spark, _t(spark, sf, "events").select("ts"))


def refuse_every_seventh(payloads) -> list[int]:
    """A stand-in for the POST transport: busy for ids divisible by seven."""
    import re
    return [503 if int(re.search(r'"id": "(-?[0-9]+)"', p).group(1)) % 7 == 0 else 200 for p in payloads]


@query
def q_stream_post(spark, sf):
    from mailstream.streaming.jobs import run_post_stream
    return run_post_stream(spark, q_post_payload(spark, sf), refuse_every_seventh)


@query
def q_stream_replay(spark, sf):
    """The failed requests of the round trip, tried again: a busy page is
    there at the second attempt, the others are given up after the third."""
    from mailstream.session import scratch_path
    from mailstream.streaming.jobs import run_replay_stream
    landed = scratch_path(spark, "replay-pages")
    page_responses(spark, sf).write.parquet(landed)
    bad = page_requests(spark, sf).filter(F.col("url").rlike(r"&retry=\d$"))

    def fetch(todo: DataFrame) -> DataFrame:
        ready = F.col("url").endswith(BUSY_SUFFIX) & (F.col("attempt") > 1)
        asked = todo.select(F.col("url").alias("_asked"), F.when(ready, F.regexp_replace("url", r"&retry=\d$", ""))
                            .otherwise(F.col("url")).alias("url"))
        got = fetch_lookup(asked, spark.read.parquet(landed), status_col="status")
        return got.select(F.col("_asked").alias("url"), "status", "body")

    first = msg.page_messages(fetch(bad.withColumn("attempt", F.lit(1))))
    return run_replay_stream(spark, first.select("url", "reason"), fetch)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
