import pandas as pd
from pyspark.sql import functions as F

from mailstream.session import scratch_path
from mailstream.sources import lines, topics
from mailstream.sources.fetch import fetch_live, fetch_lookup


def test_topic_list_and_kafka_options():
    assert topics.topic_list("a, b,,c") == ["a", "b", "c"]
    o = topics.kafka_source_options("k:9092", "urls,JsonTopic", group_id="g", min_partitions=4)
    assert o["subscribe"] == "urls,JsonTopic" and o["startingOffsets"] == "latest"
    assert o["kafka.group.id"] == "g" and o["minPartitions"] == "4"
    assert topics.kafka_sink_options("k:9092")["kafka.acks"] == "1"


def test_file_topics_round_trip(spark):
    path = scratch_path(spark, "t-topics")
    msgs = spark.createDataFrame([("a", "k1", "v1"), ("b", None, "v2"), ("c", "k3", "v3")],
                                 "topic string, key string, value string")
    topics.write_topics(msgs, path)
    got = sorted(tuple(r) for r in topics.read_topics(spark, path, "a,c").collect())
    assert got == [("a", "k1", "v1"), ("c", "k3", "v3")]
    scan = topics.topic_scan(msgs, ["b"]).collect()
    assert [(r["topic"], r["value"]) for r in scan] == [("b", "v2")]


def test_explode_lines(spark):
    df = spark.createDataFrame([(1, "a b\nc\n"), (2, "")], "id long, text string")
    got = [(r["id"], r["line_no"], r["value"]) for r in lines.explode_lines(df, "text", ("id",)).collect()]
    assert got == [(1, 1, "a b"), (1, 2, "c")]


def test_fetch_lookup_keeps_failures(spark):
    req = spark.createDataFrame([("u1",), ("u2",), ("u1",)], "url string")
    resp = spark.createDataFrame([("u1", "<x/>")], "url string, body string")
    got = sorted(tuple(r) for r in fetch_lookup(req, resp).select("url", "status", "body").collect())
    assert got == [("u1", 200, "<x/>"), ("u1", 200, "<x/>"), ("u2", 404, None)]
    got2 = fetch_lookup(req, resp, small_responses=True).count()
    assert got2 == 3


def test_fetch_live_with_pluggable_client(spark):
    def fake(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"status": [200 if u.endswith("ok") else 503 for u in urls],
                             "body": [f"<b>{u}</b>" if u.endswith("ok") else None for u in urls]})
    req = spark.createDataFrame([("a-ok",), ("b-bad",)], "url string")
    got = sorted(tuple(r) for r in fetch_live(req, fake, partitions=2).collect())
    assert got == [("a-ok", 200, "<b>a-ok</b>"), ("b-bad", 503, None)]


def test_send_payloads_pluggable_transport(spark):
    from mailstream.operators.messages import post_payload
    from mailstream.streaming.sinks import send_payloads

    sent = []

    def fake(bodies):
        sent.extend(bodies)
        return [200 if '"id": "1"' in b else 500 for b in bodies]

    ev = spark.createDataFrame([(1, "click", 1.5, "p"), (2, "view", 2.0, "q")],
                               "event_id long, event_type string, value double, props string")
    p = post_payload(ev, "event_id", "event_type", "value", "value", "props")
    got = sorted(tuple(r) for r in send_payloads(p, fake).collect())
    assert got == [(1, 200), (2, 500)]


def test_read_lines_batch_and_stream(spark):
    path = scratch_path(spark, "t-lines")
    spark.createDataFrame([("a b",), ("c",)], "value string").coalesce(1).write.text(path)
    assert sorted(r["value"] for r in lines.read_lines(spark, path).collect()) == ["a b", "c"]
    s = lines.read_lines(spark, path, streaming=True)
    assert s.isStreaming and s.columns == ["value"]


def test_replay_dead_letters(spark):
    from mailstream.operators import messages as msg
    m = spark.createDataFrame([("JsonTopic", "k", "{}", None), ("catchingTopicUrls", "u", "u", "http_404"),
                               ("catchingTopic", "", "probe", "empty")],
                              "topic string, key string, value string, reason string")
    got = sorted(tuple(r) for r in msg.replay_dead_letters(m).collect())
    assert got == [("urls", "", "probe", "empty"), ("urls", "", "u", "http_404")]
