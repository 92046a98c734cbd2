from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mailstream.functions.text import (
    blank_to_null, java_concat, java_hash, java_space_split, lines_of, parse_int,
    pmod_partition, printf_json, xml_escape,
)
from mailstream.functions.time import iso_minute, iso_second, lagged_window, minute_floor


def jhash(s: str) -> int:
    """String.hashCode computed in plain Python over UTF-16 code units."""
    h = 0
    units = s.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (31 * h + int.from_bytes(units[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_space_split_java_rules(spark):
    cases = {"": [""], "  ": [], " a b  ": ["", "a", "b"], "a  b": ["a", "", "b"],
             "a": ["a"], "a\tb \n": ["a\tb", "\n"]}
    for text, want in cases.items():
        assert one(spark, java_space_split("s"), text) == want, text
    assert one(spark, java_space_split("s"), None) is None


def test_hash_known_values(spark):
    assert one(spark, java_hash("s"), "abc") == 96354
    assert one(spark, java_hash("s"), "") == 0
    assert one(spark, java_hash("s"), "\U0001F600x") == jhash("\U0001F600x")
    assert one(spark, java_hash("s"), None) is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_hash_matches_java(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r["h"] for r in df.select(java_hash("s").alias("h")).collect()]
    assert got == [jhash(w) for w in words]


def test_partition_assignment(spark):
    df = spark.createDataFrame([("abc",), ("",), ("polygenelubricants",), (None,)], "s string")
    rows = [r["p"] for r in df.select(pmod_partition("s", 8).alias("p")).collect()]
    assert rows[0] == 2 and rows[1] == 0
    assert jhash("polygenelubricants") < 0 and rows[2] == jhash("polygenelubricants") % 8
    assert 0 <= rows[3] < 8
    assert one(spark, pmod_partition("s", 0), "abc") == 0


def test_lines_like_a_line_reader(spark):
    cases = {"": [], "a": ["a"], "a\n": ["a"], "a\n\n": ["a", ""], "a\r\nb\rc": ["a", "b", "c"]}
    for text, want in cases.items():
        assert one(spark, lines_of("s"), text) == want, repr(text)


def test_concat_blank_parse(spark):
    assert one(spark, java_concat(F.col("s"), F.lit("|"), F.lit(None)), "x") == "x|null"
    assert one(spark, blank_to_null("s"), "") is None
    assert one(spark, blank_to_null("s"), " ") == " "
    assert one(spark, parse_int("s"), "12x") is None
    assert one(spark, parse_int("s"), "1001") == 1001
    assert one(spark, xml_escape("s"), 'a<b&"c">') == "a&lt;b&amp;&quot;c&quot;&gt;"


def test_printf_payload(spark):
    df = spark.createDataFrame([(7, "t", 6.55, 'k"v')], "i long, t string, v double, p string")
    got = df.select(printf_json("i", "t", "v", "v", "p").alias("r")).first()["r"]
    assert got == '{"id": "7", "text": "t", "pos": "6.550000", "neg": "6.550000", "score": "k"v" }'


def test_time_formats_and_lag(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 9, 58, 778549),)], "ts timestamp_ntz")
    start, end = lagged_window(F.col("ts"))
    r = df.select(iso_minute("ts").alias("m"), iso_second("ts").alias("s"),
                  minute_floor("ts").alias("f"), iso_minute(start).alias("a"),
                  iso_minute(end).alias("b")).first()
    assert r["m"] == "2024-01-01T00:09:00Z" and r["s"] == "2024-01-01T00:09:58Z"
    assert r["f"] == dt.datetime(2024, 1, 1, 0, 9)
    assert (r["a"], r["b"]) == ("2024-01-01T00:03:00Z", "2024-01-01T00:04:00Z")


def test_a_cluster_without_a_shared_folder_is_refused():
    import types

    import pytest

    from mailstream.session import checkpoint_root
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(session)
