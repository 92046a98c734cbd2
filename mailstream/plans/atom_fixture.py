"""Render ``orders`` + ``lineitem`` (+ ``customer``/``nation``) as Atom feed
pages, so the XML operators run over data that grows with the tables.

Mapping (fixed, mirrored by the SQL oracles):

* one entry per order; entry id ``isie`` = ``%08X`` of ``o_orderkey``;
* lineitems with even ``l_linenumber`` are machine steps, odd are manual;
  steps ordered by (linenumber, shipdate, partkey, suppkey, extendedprice);
  ``datePublication`` = ship date;
* one address per entry from the order's customer and nation;
* page = ``o_orderkey div 1000``: at most 1000 entries, ordered by key.

One rule at every size: an order is one entry on one page, however many
steps it has (a feed cannot cut an entry, so a page row is as large as its
orders). All string building is JVM-side expressions, done after the one
shuffle of raw rows by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.functions.text import xml_escape
from mailstream.functions.time import iso_minute, iso_second
from mailstream.operators.paging import DEFAULT_BASE_URL, page_url

PAGE_ENTRIES = 1000

# Namespaces of the feed document.
FEED_OPEN = ('<feed xmlns="http://www.w3.org/1999/xhtml" '
             'xmlns:a="http://www.w3.org/2005/Atom" '
             'xmlns:openSearch="http://a9.com/-/spec/opensearch/1.1/">')
FEED_CLOSE = "</feed>"

LI_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def _attr(name: str, value: Column) -> Column:
    """`` name="value"``; null (dropped by ``concat_ws``) when value is null."""
    return F.concat(F.lit(f' {name}="'), value, F.lit('"'))


def _el(tag: str, value: Column, cls: str | None = None, **attrs: Column) -> Column:
    """``<tag class=.. attrs..>value</tag>``, or null when ``value`` is null.
    Values must already be XML-safe (see ``_escaped``)."""
    open_tag = f"<{tag}" + (f' class="{cls}"' if cls is not None else "")
    if attrs:
        head = F.concat_ws("", F.lit(open_tag), *[_attr(k, v) for k, v in attrs.items()], F.lit(">"))
    else:
        head = F.lit(open_tag + ">")
    return F.concat(head, value, F.lit(f"</{tag}>"))


def _span(cls: str, value: Column, **attrs: Column) -> Column:
    return _el("span", value, cls, **attrs)


def _xml(*parts: Column) -> Column:
    """Concatenate parts, skipping null (absent) ones."""
    return F.concat_ws("", *parts)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _int_floor(c: str) -> Column:
    return F.floor(F.col(c)).cast("long").cast("string")


def _pct(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("int").cast("string")


def _escaped(df: DataFrame, cols: list[str]) -> DataFrame:
    """Escape the free-text columns once; numbers, dates and fixed
    literals need no escaping."""
    return df.select(*[xml_escape(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def machine_li() -> Column:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    date_debut = F.when(status == "O", F.lit("")).otherwise(
        iso_second(F.col("l_shipdate") - F.make_interval(days=F.lit(1))))
    lot = F.when(flag == "R", F.concat(F.lit("<dt>lot</dt><dd>"), _int_floor("l_quantity"),
                                       F.lit("</dd>")))
    cedex_cls = F.when(flag == "A", F.lit("Cedex")).otherwise(F.lit("cedex"))
    cedex_val = F.when(F.col("l_tax") >= 0.04, F.lit("oui")).otherwise(F.lit("non"))
    return _xml(
        F.lit("<li>"),
        _span("dateDebut", date_debut),
        _span("idMachineTri", _s("l_partkey")),
        _span("entreeMachine", F.concat(_s("l_linenumber"), F.lit("-1"))),
        _span("idPlateforme", F.concat(F.lit("S"), _s("l_suppkey"))),
        _el("abbr", flag, "programmeTri",
            title=F.concat(_s("l_partkey"), F.lit("-"), _s("l_suppkey")), id=_s("l_linenumber")),
        F.lit('<dl class="parametresTri">'), lot,
        F.lit("<dt>triSanctionPartiel</dt><dd>"), _pct("l_discount"), F.lit("</dd></dl>"),
        _span("etat", status),
        _el("span", F.concat(flag, _s("l_linenumber")), "receptacle",
            title=F.lit("0"), type=F.lit("FINAL"), niveau=_s("l_linenumber"),
            lang=F.when(flag == "N", F.lit("fr"))),
        F.lit('<div class="client">'),
        _span("receptacleReel", F.concat(F.lit("R"), _s("l_suppkey")), niveau=_pct("l_tax"),
              title=status, lang=F.when(flag == "A", F.lit("fr"))),
        _span("raisonModificationReceptacle", F.when(flag == "R", F.lit("SATURE"))),
        F.lit("</div>"),
        _span("plateformeSuivante", F.concat(F.lit("P"), _s("l_partkey"))),
        _span("valeur_adresse_prioritaire", _int_floor("l_extendedprice")),
        _span("type_adresse_prioritaire",
              F.when(status == "F", F.lit("zone")).otherwise(F.lit("round"))),
        F.lit('<span class="'), cedex_cls, F.lit('">'), cedex_val, F.lit("</span>"),
        F.lit('<span class="service">NO &lt;SERVICE&gt; = R&amp;D</span>'),
        _span("datePublication", iso_second("l_shipdate")),
        F.lit("</li>"))


def manual_li() -> Column:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    date = F.when(status == "O", F.lit("")).otherwise(iso_second("l_shipdate"))
    return _xml(
        F.lit("<li>"), _span("date", date), _span("type", flag),
        _span("etat", status, title=F.concat(F.lit("S"), _s("l_linenumber"))),
        F.lit('<div class="client">'),
        _span("idCentreVideocodage", F.concat(F.lit("V"), _s("l_suppkey"))),
        _span("duree", _int_floor("l_quantity")),
        _span("nomOperateur", F.concat(F.lit("op"), _s("l_partkey"))),
        _span("datePublication", iso_second("l_shipdate")),
        _span("sequenceFrappe", _s("l_linenumber")),
        _span("raisonFin", flag),
        F.lit("</div></li>"))


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority", "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
              "n_name", "n_regionkey"]


def _page(key: str, page_entries: int) -> Column:
    return F.floor(F.col(key) / page_entries).cast("long")


def step_rows(lineitem: DataFrame, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """Raw lineitem columns per step with ``(page, okey)``."""
    li = _escaped(lineitem.select(*LI_COLS), ["l_returnflag", "l_linestatus"])
    return li.select(_page("l_orderkey", page_entries).alias("page"),
                     F.col("l_orderkey").alias("okey"), *LI_COLS[1:])


def order_rows(orders: DataFrame, customer: DataFrame, nation: DataFrame,
               page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """Order, customer and nation columns per entry with ``(page, okey)``."""
    cust = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    o = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       "o_orderdate", "o_orderpriority")
         .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
         .join(nat, "c_nationkey", "left"))
    o = _escaped(o, ["o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name"])
    return o.select(_page("o_orderkey", page_entries).alias("page"),
                    F.col("o_orderkey").alias("okey"), *ORDER_COLS)


def _join_steps(steps: Column, machine: bool) -> Column:
    picked = F.filter(steps, lambda s: s["machine"] == F.lit(machine))
    return F.array_join(F.transform(picked, lambda s: s["xml"]), "")


def entry_xml() -> Column:
    """The ``<a:entry>`` text from the order columns and ``steps``."""
    isie = F.format_string("%08X", F.col("o_orderkey"))
    status = F.col("o_orderstatus")
    published = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(
        iso_second(F.col("o_orderdate") + F.make_interval(days=F.lit(1))))
    img = (F.when(status == "F", F.lit("jpeg")).when(status == "O", F.lit("png")))
    link = F.concat(F.lit('<a:link rel="alternate" href="http://img.example/'), isie,
                    F.lit("/image?format="), img, F.lit('"/>'))
    title = _xml(
        F.lit('<a:title type="xhtml"><div>'),
        _span("format", status), _span("etat", F.concat(F.lit("E"), status)),
        _span("priorite", F.col("o_orderpriority")), _span("id", isie, title=F.lit("imp")),
        _el("div", F.when(F.col("o_totalprice") >= 250000, F.lit("oui")).otherwise(F.lit("non")),
            "expires"),
        F.lit('<div class="client">'), _span("cleExterne", F.concat(F.lit("C"), _s("o_custkey"))),
        F.lit("</div></div></a:title>"))
    address = F.when(F.col("c_custkey").isNotNull(), _xml(
        F.lit('<ul class="adresses"><li>'),
        _span("type", F.lit("SCAN")), _span("code", F.col("c_name")),
        F.lit('<div class="client">'),
        _span("codeAcheDistri", F.concat(F.col("n_name"), F.lit("-"), _s("c_nationkey"))),
        F.lit("</div>"),
        _span("idRao", _s("c_custkey")), _span("typeRao", F.col("c_mktsegment")),
        _span("idRaoLivraison", _s("n_regionkey")), _span("typeRaoLivraison", F.lit("stops")),
        F.lit("</li></ul>")))
    uls = F.when(F.size(F.col("steps")) > 0, F.concat(
        F.lit('<ul class="traitement">'), _join_steps(F.col("steps"), True), F.lit("</ul>"),
        F.lit('<ul class="traitementManuel">'), _join_steps(F.col("steps"), False), F.lit("</ul>")))
    return _xml(
        F.lit("<a:entry>"), title,
        F.lit("<a:id>urn:parcel:"), isie, F.lit("</a:id>"),
        F.lit("<a:updated>"), iso_second("o_orderdate"), F.lit("</a:updated>"),
        F.concat(F.lit("<a:author><a:name>"), F.col("n_name"), F.lit("</a:name></a:author>")),
        link,
        F.lit('<a:content type="xhtml"><div>'), _span("derivation", F.col("c_mktsegment")),
        uls, address, F.lit("</div></a:content>"),
        F.lit("<a:published>"), published, F.lit("</a:published></a:entry>"))


# Bytes of step files whose pages one task renders, at most.
TASK_BYTES = 2 << 20
#: Larger than any table: the planner does not know the size.
_UNKNOWN_BYTES = 1 << 50


def page_partitions(steps: DataFrame) -> int:
    """Tasks that render pages: the session's shuffle partitions, or more where
    the step table is larger than ``TASK_BYTES`` for each. A task holds the
    texts of its pages while it groups them, so their number must not grow with
    the table. The size is the planner's, from the files; no job runs."""
    n = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(steps._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if size >= _UNKNOWN_BYTES else max(n, -(-size // TASK_BYTES))


def entry_rows(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
               nation: DataFrame, page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """``(page, o_orderkey, o_orderdate, xml)`` per entry.

    Order rows and step rows (raw columns, compact) are unioned and
    shuffled once by page. Grouping per entry ``(page, okey)`` and,
    downstream, per page reuse that partitioning, so the rendered XML never
    crosses a shuffle and no join sorts the steps. Steps whose order is
    missing are dropped (as a left join from orders would).
    """
    # pages are few, large rows whose consumers (XML parsing) are CPU-heavy:
    # place them by count so AQE does not merge them into fewer tasks than
    # cores; every grouping below reuses this placement
    n = page_partitions(lineitem)
    both = (order_rows(orders, customer, nation, page_entries)
            .withColumn("_is_step", F.lit(False))
            .unionByName(step_rows(lineitem, page_entries).withColumn("_is_step", F.lit(True)),
                         allowMissingColumns=True)
            .repartition(n, "page"))
    is_step = F.col("_is_step")
    machine = (F.col("l_linenumber") % 2) == 0
    # the step's text is a column of its own (read twice, so not folded into the
    # aggregate, which would interpret it row by row instead of compiling it)
    both = both.withColumn("_xml", F.when(is_step, F.when(machine, machine_li()).otherwise(manual_li())))
    step = F.when(F.col("_xml").isNotNull(), F.struct(*[F.col(c) for c in LI_ORDER], machine.alias("machine"),
                                                      F.col("_xml").alias("xml")))
    order = F.when(~is_step, F.struct(*[F.col(c) for c in ORDER_COLS]))
    grouped = (both.groupBy("page", "okey")
               .agg(F.first(order, ignorenulls=True).alias("_o"),
                    F.sort_array(F.collect_list(step)).alias("steps"))
               .filter(F.col("_o").isNotNull())
               .select("page", "steps", "_o.*"))
    return grouped.select("page", "o_orderkey", "o_orderdate", entry_xml().alias("xml"))


def _page_url(base_url: str, page_entries: int) -> Column:
    """The URL of a page covering order dates ``lo..hi``."""
    start_index = F.col("page") * page_entries + 1
    return page_url(iso_minute("lo"), iso_minute("hi"), start_index, F.lit(page_entries), base_url)


def render_pages(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
                 nation: DataFrame, base_url: str = DEFAULT_BASE_URL,
                 page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """Feed pages ``(url, status, body, page, n_entries)``; one row per page
    with at most ``page_entries`` entries."""
    ent = entry_rows(orders, lineitem, customer, nation, page_entries)
    grouped = (ent.groupBy("page")
               .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "xml"))).alias("es"),
                    F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"),
                    F.count(F.lit(1)).alias("n_entries")))
    body = F.concat(F.lit(FEED_OPEN), F.lit("<openSearch:totalResults>"), _s("n_entries"),
                    F.lit("</openSearch:totalResults>"),
                    F.array_join(F.transform(F.col("es"), lambda x: x["xml"]), ""),
                    F.lit(FEED_CLOSE))
    return grouped.select(_page_url(base_url, page_entries).alias("url"), F.lit(200).alias("status"),
                          body.alias("body"), "page",
                          F.col("n_entries").cast("long").alias("n_entries"))


def page_index(orders: DataFrame, base_url: str = DEFAULT_BASE_URL,
               page_entries: int = PAGE_ENTRIES) -> DataFrame:
    """``(page, url, n_entries)`` of every rendered page, from the order keys
    and dates alone: the request list, without rendering. A partial aggregate
    per page."""
    rows = orders.select(_page("o_orderkey", page_entries).alias("page"), "o_orderdate")
    g = rows.groupBy("page").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"),
                                 F.count(F.lit(1)).alias("n_entries"))
    return g.select("page", _page_url(base_url, page_entries).alias("url"),
                    F.col("n_entries").cast("long").alias("n_entries"))
