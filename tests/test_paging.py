from pyspark.sql import functions as F

from mailstream.operators import paging


def _plan(spark, inclusive, block_pages=paging.BLOCK_PAGES, step=1000, upto=3002):
    probes = spark.range(0, upto).select(F.col("id").alias("total"))
    out = paging.page_plan(probes, "total", step, inclusive=inclusive, block_pages=block_pages)
    got = {}
    for r in out.collect():
        got.setdefault(r["total"], []).append(r["start_index"])
        assert r["count"] == step
    return got


def test_inclusive_plan_covers_every_row_once(spark):
    got = _plan(spark, True, block_pages=3)
    for n in range(0, 3002):
        starts = sorted(got.get(n, []))
        covered = [i for s in starts for i in range(s, s + 1000) if i <= n]
        assert covered == list(range(1, n + 1)), n


def test_exclusive_plan_is_the_observed_loop(spark):
    got = _plan(spark, False)
    for n in range(0, 3002):
        assert sorted(got.get(n, [])) == list(range(1, n, 1000)), n
    assert got.get(1) is None          # a single row is never requested
    assert sorted(got[1001]) == [1]    # ... and row 1001 is lost


def test_urls(spark):
    df = spark.createDataFrame([("2024-01-01T00:03:00Z", "2024-01-01T00:04:00Z", 1, 1000)],
                               "start string, end string, start_index int, count int")
    url = paging.page_urls(df, "http://h/x?").first()["url"]
    assert url == ("http://h/x?dateDebut=2024-01-01T00:03:00Z&dateFin=2024-01-01T00:04:00Z"
                   "&startIndex=1&count=1000")
    probe = df.select(paging.probe_url(F.col("start"), F.col("end"), "b?").alias("u")).first()["u"]
    assert probe.endswith("&startIndex=1&count=1")


def test_page_slices_global_order(spark):
    keys = [7, 3, 3, 11, 1, 20, 5, 9, 2, 15, 4, 8]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    out = paging.page_slices(df, ["k", "i"], page_size=5, num_ranges=3).collect()
    ranked = sorted(out, key=lambda r: r["row_index"])
    assert [r["row_index"] for r in ranked] == list(range(1, len(keys) + 1))
    assert [r["k"] for r in ranked] == sorted(keys)
    assert [r["page"] for r in ranked] == [(i - 1) // 5 for i in range(1, len(keys) + 1)]
    assert {r["start_index"] for r in ranked if r["page"] == 1} == {6}
