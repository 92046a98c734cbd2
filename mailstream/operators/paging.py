"""Turn window totals into paged requests, and page a table server-side.

``page_plan`` is the generator ``for (i = 1; i <= n; i += step)``; the
observed variant stops at ``i < n`` (a total of 1 yields no page and any
total of the form ``k*step + 1`` loses its last row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Page size and the request query-string layout.
STEP = 1000
DEFAULT_BASE_URL = "http://feed.example/items/poll?"
BEGIN = "dateDebut="
END = "dateFin="
START_INDEX = "startIndex="
COUNT = "count="
SEP = "&"

# Pages generated from one total are produced in blocks of this many pages;
# blocks are spread over tasks before the inner explode, so one huge window
# total never becomes a single task emitting millions of requests.
BLOCK_PAGES = 1024


def page_plan(probes: DataFrame, total_col: str = "total", step: int = STEP,
              inclusive: bool = True, block_pages: int = BLOCK_PAGES,
              spread: bool = True) -> DataFrame:
    """One row per page request: all probe columns plus ``start_index``
    (1-based) and ``count`` (= step)."""
    n = F.col(total_col).cast("long")
    last = n if inclusive else n - 1          # largest allowed start index
    pages = F.when(last >= 1, F.floor((last - 1) / step) + 1).otherwise(F.lit(0))
    blocks = F.when(pages > 0, F.sequence(F.lit(0).cast("long"),
                                          F.floor((pages - 1) / block_pages).cast("long")))
    staged = (probes.withColumn("_pages", pages.cast("long"))
              .withColumn("_block", F.explode(blocks)))
    if spread:
        # rows here are (probe, block): tiny; spreading them balances the
        # inner explode when a single window holds most of the data
        staged = staged.repartition(F.col("_block"), *[F.col(c) for c in probes.columns])
    lo = F.col("_block") * block_pages
    hi = F.least(F.col("_pages"), lo + block_pages) - 1
    out = staged.withColumn("_page", F.explode(F.sequence(lo, hi)))
    return (out.withColumn("start_index", (F.col("_page") * step + 1).cast("long"))
            .withColumn("count", F.lit(step).cast("int"))
            .drop("_pages", "_block", "_page"))


def page_url(start, end, start_index, count, base_url: str = DEFAULT_BASE_URL):
    """``base dateDebut=S&dateFin=E&startIndex=I&count=C``."""
    return F.concat(F.lit(base_url), F.lit(BEGIN), start, F.lit(SEP), F.lit(END), end,
                    F.lit(SEP), F.lit(START_INDEX), start_index.cast("string"),
                    F.lit(SEP), F.lit(COUNT), count.cast("string"))


def page_urls(plan: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    return plan.withColumn("url", page_url(F.col("start"), F.col("end"), F.col("start_index"),
                                           F.col("count"), base_url))


def probe_url(start, end, base_url: str = DEFAULT_BASE_URL):
    """The one-row count probe for a window (``startIndex=1&count=1``)."""
    return page_url(start, end, F.lit(1), F.lit(1), base_url)


def page_slices(df: DataFrame, order_cols: list[str], page_size: int = STEP,
                num_ranges: int | None = None) -> DataFrame:
    """Server-side paging of a whole table: every row gets its global
    1-based ``row_index`` in ``order_cols`` order, its ``page`` (0-based) and
    the page's ``start_index``.

    A global ``row_number()`` without partitioning would pull the table
    into one task. Instead: range-partition and sort by the order columns;
    ``monotonically_increasing_id`` then carries each row's range (upper
    bits) and its position inside the sorted range (lower 33 bits), all
    JVM-side. A checkpoint cuts lineage so the numbering is fixed once;
    each range's offset comes from a prefix sum over the per-range counts
    (one row per range: a bounded table, broadcast).
    """
    from mailstream.session import checkpoint_root

    spark = df.sparkSession
    checkpoint_root(spark)          # the shared folder checkpoint() writes to
    # without an explicit count AQE may merge adjacent ranges; a merged
    # partition is still one contiguous, sorted key range
    ranged = (df.repartitionByRange(num_ranges, *order_cols) if num_ranges
              else df.repartitionByRange(*order_cols))
    mid = F.monotonically_increasing_id()
    numbered = (ranged.sortWithinPartitions(*order_cols)
                .withColumn("_mid", mid)
                .withColumn("_range", F.shiftright(F.col("_mid"), 33).cast("int"))
                .withColumn("_local", (F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long"))
                .drop("_mid")
                .checkpoint(eager=True))
    sizes = numbered.groupBy("_range").agg(F.max("_local").alias("_n"))
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    ranked = numbered.join(F.broadcast(offsets), "_range")
    idx = (F.col("_offset") + F.col("_local")).cast("long")
    page = F.floor((idx - 1) / page_size).cast("long")
    return (ranked.withColumn("row_index", idx).withColumn("page", page)
            .withColumn("start_index", (page * page_size + 1).cast("long"))
            .drop("_range", "_local", "_offset"))
