"""The message envelope ``(topic, key, value)`` and routing.

One stream, many topics: the topic is a computed column, so one write
serves every lane (the main lane and the catch/dead-letter lane). The
``partition`` column places a message the way the producer's partitioner
did, with the empty-key hot spot removed (see ``assign_partition``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.functions.text import pmod_partition, printf_json
from mailstream.operators import paging
from mailstream.operators.feed import classes, parse_feed, parse_header, pick
from mailstream.operators.parcels import (
    ENTRY_LK, entry_lookups, li_lookups, parcel_columns, parcel_json, parcel_key, step_array, step_columns, step_id,
)

# Topic names.
URLS_TOPIC = "urls"
CATCH_WINDOWS_TOPIC = "catchingTopic"
PARCELS_TOPIC = "JsonTopic"
CATCH_URLS_TOPIC = "catchingTopicUrls"

MESSAGE_COLUMNS = ["topic", "key", "value"]


def assign_partition(msgs: DataFrame, n: int, key_col: str = "key",
                     spread_col: str = "value", seq_col: str | None = None) -> DataFrame:
    """``partition = hashCode(key) mod n`` (non-negative). The URL lanes
    use an empty key, which would send every message to partition 0; an
    empty key is therefore placed by ``spread_col`` instead. A null key goes
    round the partitions by the message's place in its log (``seq_col``), so
    the spread is even and a replayed batch places its rows alike; without
    ``seq_col`` it is placed by ``spread_col`` too."""
    key = F.col(key_col)
    spread = pmod_partition(spread_col, n)
    turn = F.pmod(F.col(seq_col), F.lit(n)).cast("int") if seq_col else spread
    place = F.when(key.isNull(), turn).when(key == F.lit(""), spread).otherwise(pmod_partition(key, n))
    return msgs.withColumn("partition", place)


def route_windows(totals: DataFrame, base_url: str = paging.DEFAULT_BASE_URL,
                  step: int = paging.STEP, inclusive: bool = True) -> DataFrame:
    """Window totals -> messages, in one pass. A positive total becomes one
    page request per ``step`` rows on the ``urls`` topic; a zero total, or none
    (null or negative), becomes one count probe on the catch topic, with a
    ``reason``. Other columns of ``totals`` are kept."""
    total = F.col("total").cast("long")
    live = F.coalesce(total > 0, F.lit(False))
    # a window without pages has one row all the same: its probe
    plan = paging.page_plan(totals.withColumn("_n", F.when(live, total).otherwise(1 if inclusive else 2)), "_n", step, inclusive)
    start, end = F.col("start"), F.col("end")
    url = F.when(live, paging.page_url(start, end, F.col("start_index"), F.col("count"), base_url)).otherwise(
        paging.probe_url(start, end, base_url))
    return plan.select(F.when(live, F.lit(URLS_TOPIC)).otherwise(F.lit(CATCH_WINDOWS_TOPIC)).alias("topic"),
                       F.lit("").alias("key"), url.alias("value"),
                       F.when(~live, F.when(total == 0, F.lit("empty")).otherwise(F.lit("failed"))).alias("reason"), *totals.columns)


def probe_windows(windows: DataFrame, fetch: Callable[[DataFrame], DataFrame],
                  base_url: str = paging.DEFAULT_BASE_URL) -> DataFrame:
    """The count probe of each window: ``windows(start, end)`` -> ``start, end,
    total, cause``. ``fetch`` turns ``(url)`` into ``(url, status, body)``; the
    total is what the fetched count page says. ``cause`` tells why there is
    none: ``http_<status>``, ``parse_error`` or ``no_total``. A window is read
    off its URL, so nothing is joined back."""
    urls = windows.select(paging.probe_url(F.col("start"), F.col("end"), base_url).alias("url"))
    page = parse_header(fetch(urls))
    st, total = F.col("status"), F.col("total_results")
    cause = (F.when(st.isNull() | (st != 200), F.concat(F.lit("http_"), F.coalesce(st.cast("string"), F.lit("none"))))
             .when(~F.col("parse_ok"), F.lit("parse_error")).when(total.isNull() | (total < 0), F.lit("no_total")))
    of = lambda name: F.regexp_extract("url", rf"[?&]{name}([^&]*)", 1)
    return (page.withColumn("cause", cause)
            .select(of(paging.BEGIN).alias("start"), of(paging.END).alias("end"),
                    F.when(F.col("cause").isNull(), total).cast("long").alias("total"), "cause"))


def with_page_steps(pages: DataFrame) -> DataFrame:
    """Add ``_steps``, all steps of a page in document order as ``(key, e, _k,
    li)``, and ``_parents``, the entries' own fields; ``e`` is a step's entry
    there (0-based). An entry's fields are made once, not for each step."""
    looked = pages.withColumn("_looked", F.transform("entries", lambda e: F.struct(
        *[c.alias(n) for n, c in entry_lookups(e).items()])))

    def parent(e: Column, i: Column) -> Column:
        found = F.get(F.col("_looked"), i)
        return F.struct(*[c.alias(n) for n, c in parcel_columns(e, {n: found[n] for n in ENTRY_LK}).items()])

    def of(e: Column, i: Column) -> Column:
        isie = F.get(F.col("_parents"), i)["isie"]
        return F.transform(step_array(e), lambda s: F.struct(
            parcel_key(isie, step_id(s["_k"], s["li"])).alias("key"), i.alias("e"), s["_k"].alias("_k"), s["li"].alias("li")))

    return (looked.withColumn("_parents", F.transform("entries", parent))
            .withColumn("_steps", F.flatten(F.transform("entries", of))).drop("_looked"))


def last_places(steps: Column) -> Column:
    """Places (0-based, ascending) of the last step of every key of a page:
    places sorted by key, of which those stay that another key follows."""
    by_key = F.sort_array(F.transform(steps, lambda s, i: F.struct(s["key"].alias("key"), i.alias("i"))))
    ends = F.zip_with(by_key, F.slice(by_key, 2, F.greatest(F.size(by_key), F.lit(1))),
                      lambda a, b: F.when(b.isNull() | (a["key"] != b["key"]), a["i"]))
    return F.sort_array(F.filter(ends, lambda i: i.isNotNull()))


def page_messages(fetched: DataFrame, dedupe: bool = True, failed_only: bool = False) -> DataFrame:
    """Fetched pages ``(url, status, body)`` -> messages
    ``(topic, key, value, reason, url)``.

    * status 200 and a well-formed feed: one message per parcel on the
      parcel topic, key ``isie|datePublication``, value the parcel JSON;
      with ``dedupe`` only the last parcel per key within a page is kept;
    * status 200 but malformed: the URL on the catch topic, reason
      ``parse_error`` (nothing is lost silently);
    * any other status: the URL on the catch topic, reason ``http_<status>``.

    Narrow: a page is parsed once, the last step of each of its keys is chosen
    inside the page's own row by sorting its keys, and only the survivors
    become rows and JSON. A URL fetched twice gives its messages twice, as two
    responses do. Failed pages ride the same explode as one row. The lane is
    read off the exploded step, so a filter on it stays above the explode and
    does not repeat the parse below it.

    ``failed_only`` gives the catch topic's messages alone: every page is
    checked as a whole, but no entry is built.
    """
    st = F.col("status")
    pages = fetched.withColumn("body", F.when(st == 200, F.col("body")))
    failed = F.when(st.isNull() | (st != 200), F.concat(F.lit("http_"), F.coalesce(st.cast("string"), F.lit("none"))))
    reason = failed.when(~F.col("parse_ok"), F.lit("parse_error"))
    if failed_only:
        # the reason is made twice by a filter on it: once for the rows that stay
        bad = parse_header(pages).withColumn("reason", reason).filter(F.col("reason").isNotNull())
        return bad.select(F.lit(CATCH_URLS_TOPIC).alias("topic"), F.col("url").alias("key"), F.col("url").alias("value"), "reason", "url")
    parsed = parse_feed(pages).withColumn("reason", reason)
    whole = with_page_steps(parsed.select("url", "reason", F.when(F.col("reason").isNull(), F.col("entries")).alias("entries")))
    if dedupe:
        whole = whole.withColumn("_last", last_places(F.col("_steps")))
        kept = F.transform("_last", lambda i: F.get(F.col("_steps"), i))
    else:
        kept = F.col("_steps")
    kept = F.transform(kept, lambda s: F.struct(*[s[c].alias(c) for c in ("key", "_k", "li")], F.get(F.col("_parents"), s["e"]).alias("parent")))
    rows = (whole.select("url", "reason", F.explode_outer(kept).alias("_s"))
            .filter(F.col("reason").isNotNull() | F.col("_s").isNotNull())
            .select("url", "reason", F.col("_s").isNotNull().alias("_ok"), "_s.key", "_s._k", "_s.li", "_s.parent.*"))
    parcel = step_columns(rows.withColumns(li_lookups(F.col("li"))))
    ok = F.col("_ok")
    return parcel.select(F.when(ok, F.lit(PARCELS_TOPIC)).otherwise(F.lit(CATCH_URLS_TOPIC)).alias("topic"),
                         F.when(ok, F.col("key")).otherwise(F.col("url")).alias("key"),
                         F.when(ok, parcel_json(parcel)).otherwise(F.col("url")).alias("value"), "reason", "url")


def replay_dead_letters(msgs: DataFrame, request_topic: str = URLS_TOPIC) -> DataFrame:
    """The retry hand-off: every message on a catch lane (a failed or
    unparseable page URL, or the count probe of an empty window) becomes a
    fresh request on ``request_topic``; ``retry_reason`` keeps why."""
    dead = msgs.filter(F.col("topic").isin(CATCH_URLS_TOPIC, CATCH_WINDOWS_TOPIC))
    return dead.select(F.lit(request_topic).alias("topic"), F.lit("").alias("key"),
                       F.col("value"), F.col("reason").alias("retry_reason"))


def page_result_map(keyed_json: DataFrame) -> DataFrame:
    """A page's result as one ``map<key, json>`` per URL (the page map); its
    size is bounded by the page (<= entries x steps per page)."""
    return keyed_json.groupBy("url").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("result"))


def explode_result_map(maps: DataFrame) -> DataFrame:
    """Map -> ``(url, key, value)`` rows."""
    return maps.select("url", F.explode("result").alias("key", "value"))


def post_payload(df: DataFrame, id_col: str, text_col: str, pos_col: str, neg_col: str,
                 score_col: str) -> DataFrame:
    """The POST body per row (printf bytes, unescaped like the original)
    and a safely escaped JSON of the same five fields."""
    safe = F.to_json(F.struct(F.col(id_col).cast("string").alias("id"),
                              F.col(text_col).alias("text"),
                              F.col(pos_col).cast("float").alias("pos"),
                              F.col(neg_col).cast("float").alias("neg"),
                              F.col(score_col).alias("score")))
    return df.select(F.col(id_col).alias("id"),
                     printf_json(id_col, text_col, pos_col, neg_col, score_col).alias("payload"),
                     safe.alias("payload_json"))
