"""Hot keys: an order with many steps, a URL requested many times."""

import duckdb
import pytest
from pyspark.sql import functions as F

from mailstream.plans import atom_fixture as A
from mailstream.plans.oracle import oracle_sql
from mailstream.plans.queries import queries
from mailstream.sources.fetch import fetch_lookup
from mailstream.sources.tables import table
from tests.test_queries import _rows

TABLES = ["orders", "lineitem", "customer", "nation"]


@pytest.fixture(scope="module")
def hot_sf(tmp_path_factory):
    """The small tables, with one order that has over 1,000 more steps."""
    out = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for t in TABLES:
        rows = f"SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')"
        if t == "lineitem":
            rows += (f" UNION ALL SELECT * REPLACE ((SELECT min(l_orderkey) FROM ({rows})) AS l_orderkey)"
                     f" FROM (SELECT * FROM ({rows}) ORDER BY ALL LIMIT 1200)")
        con.execute(f"COPY ({rows}) TO '{out}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    return str(out), con


@pytest.mark.parametrize("name", ["parcels", "parcels_last", "treatment_counts", "addresses", "entry_positions",
                                  "route_pages"])
def test_hot_order_follows_the_oracle(spark, hot_sf, name):
    sf, duck = hot_sf
    got = queries()[name](spark, sf)
    want = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in want.description]
    flat = got.select(*cols)
    assert _rows(cols, flat.collect()) == _rows(cols, want.fetchall())


def test_page_index_lists_every_rendered_page(spark, sf_small):
    """Requests are built from the orders alone; they name exactly the
    rendered pages, with their entry counts."""
    t = lambda n: table(spark, sf_small, n)
    pages = A.render_pages(t("orders"), t("lineitem"), t("customer"), t("nation"))
    cols = ["page", "url", "n_entries"]
    assert sorted(A.page_index(t("orders")).select(*cols).collect()) == sorted(pages.select(*cols).collect())


def test_url_requested_many_times(spark):
    req = spark.range(50_000).select(F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(
        F.concat(F.lit("u"), F.col("id").cast("string"))).alias("url"))
    resp = spark.createDataFrame([("hot", "H"), ("u10", "T"), ("u20", "U")], "url string, body string")
    got = {(r["status"], r["body"]): r["n"] for r in fetch_lookup(req, resp).groupBy("status", "body")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(200, "H"): 45_000, (200, "T"): 1, (200, "U"): 1, (404, None): 4_998}
