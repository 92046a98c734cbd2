"""Parse Atom feed pages with one ``from_xml`` per page: well-formedness,
``totalResults`` and the entries come from the same parse.

An entry is an ``entry`` element of the Atom namespace directly below the
feed. Position is the parser's business: the schema lists only the feed's own
children, so elements of that name deeper in the tree, in comments or in CDATA
are never read. The namespace of a child of the feed depends on two tags, the
feed's and its own, so it is settled on the few distinct entry start tags of a
page; tags of another namespace get an attribute that the schema reads, and
only pages that have such tags are rewritten.

The schema is explicit and all-string: inference would turn a lone repeated
child into a struct and ids into numbers. All other elements are matched by
local name, whatever their prefix. Only the fields listed here are
materialised, which is the column pruning for XML (``KEY_ENTRY`` is the
narrower schema for key-only readers). Unparseable pages keep their text in
``_corrupt_record``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.functions.text import xml_escape
from mailstream.operators import plain_feed


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


SPAN = T.StructType(_s("_class", "_title", "_type", "_niveau", "_lang", "_VALUE"))
ABBR = T.StructType(_s("_class", "_title", "_id", "_VALUE"))
DL = T.StructType(_s("_class") + [T.StructField("dt", T.ArrayType(T.StringType())),
                                  T.StructField("dd", T.ArrayType(T.StringType()))])
DIV = T.StructType(_s("_class", "_VALUE") + [T.StructField("span", T.ArrayType(SPAN))])
LI = T.StructType([T.StructField("span", T.ArrayType(SPAN)),
                   T.StructField("abbr", T.ArrayType(ABBR)),
                   T.StructField("dl", T.ArrayType(DL)),
                   T.StructField("div", T.ArrayType(DIV))])
UL = T.StructType(_s("_class") + [T.StructField("li", T.ArrayType(LI))])
LINK = T.StructType(_s("_rel", "_href"))
ENTRY = T.StructType([
    T.StructField("title", T.StructType([T.StructField("div", T.StructType([
        T.StructField("span", T.ArrayType(SPAN)), T.StructField("div", T.ArrayType(DIV))]))])),
    *_s("id", "updated", "published"),
    T.StructField("author", T.StructType(_s("name"))),
    T.StructField("link", T.ArrayType(LINK)),
    T.StructField("content", T.StructType([T.StructField("div", T.StructType([
        T.StructField("span", T.ArrayType(SPAN)), T.StructField("ul", T.ArrayType(UL))]))])),
])

# A pruned entry for consumers that read only classes and text: the title
# spans, and per list item its spans and its divs' spans. Spark does not
# prune a ``from_xml`` schema from the fields used downstream, so queries
# that need only ids, step dates, counts or addresses parse this instead.
_CV = T.StructType(_s("_class", "_VALUE"))
KEY_LI = T.StructType([T.StructField("span", T.ArrayType(_CV)),
                       T.StructField("div", T.ArrayType(T.StructType(
                           _s("_class") + [T.StructField("span", T.ArrayType(_CV))])))])
_TITLE = T.StructField("title", T.StructType([T.StructField("div", T.StructType([
    T.StructField("span", T.ArrayType(_CV))]))]))


def _lists(li: T.StructType) -> T.StructType:
    return T.StructType([_TITLE, T.StructField("content", T.StructType([T.StructField("div", T.StructType([
        T.StructField("ul", T.ArrayType(T.StructType(_s("_class") + [T.StructField("li", T.ArrayType(li))])))]))]))])


KEY_ENTRY = _lists(KEY_LI)
# For readers of ids alone, and of ids and the length of lists: what is inside
# the content, or inside a list item, is checked by the parser and not built.
TITLE_ENTRY = T.StructType([_TITLE])
LIST_ENTRY = _lists(T.StructType(_s("_class")))
# For readers that only count entries.
COUNT_ENTRY = T.StructType(_s("id"))
HEADER = T.StructType([T.StructField("totalResults", T.StringType()),
                       T.StructField("_corrupt_record", T.StringType())])

XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "_corrupt_record"}

# Fixed value: the namespace of feed entries.
ATOM = "http://www.w3.org/2005/Atom"
# possessive: a name is never tried again in a shorter form
_NAME = r"[A-Za-z_][\w.\-]*+"
_QUOTED = r"""(?:[^<>"']|"[^"]*"|'[^']*')*"""
_ROOT = rf"(?s)<{_NAME}(?::{_NAME})?(?=[\s/>]){_QUOTED}>"
_DECLARED = rf"""\sxmlns(?::({_NAME}))?\s*=\s*["']([^"']*)["']"""
_ENTRY_TAG = rf"(?s)<(?:{_NAME}:)?entry(?=[\s/>]){_QUOTED}>"
_CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"
_HIDDEN = r"(?s)<!--.*?-->|<\?.*?\?>|(<!\[CDATA\[.*?\]\]>)"
#: Attribute that marks an entry tag of another namespace.
_OTHER = "other-namespace"
# Text and attribute value of a span that may be left out: no markup, nothing
# that XML forbids, no entity but XML's own. Single characters, which the
# matcher looks up at once, unlike ranges.
_FORBIDDEN = "".join(rf"\x{c:02x}" for c in range(32) if c not in (9, 10, 13))
_PLAIN = rf"[^<&\]{_FORBIDDEN}]*+"
_TEXT = rf"{_PLAIN}(?:&(?:amp|lt|gt|quot|apos);{_PLAIN}){{0,16}}+"
_VALUE = rf"""[^<>&"\x09\x0a\x0d{_FORBIDDEN}]*+"""
#: Spans left out at once; a longer run goes in several matches.
_RUN = 64


def parse_header(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``total_results`` (``openSearch:totalResults`` as int) and
    ``parse_ok`` (body present and well-formed). The header schema has no
    entries, so the parser checks the whole page but builds nothing big."""
    return parse_feed(pages, None, body_col).drop("entries")


def parse_feed(pages: DataFrame, schema: T.StructType | None = ENTRY, body_col: str = "body",
               spans: tuple[str, ...] | None = None, texts: bool = False) -> DataFrame:
    """Add ``total_results``, ``parse_ok`` and ``entries``, the page's Atom
    entries in order as an array of ``schema`` (null for a page that is not
    well-formed; without a schema always null). ``spans`` names the classes of
    spans that the caller looks up, with a schema that has no text but theirs:
    others may be missing (see ``without_spans``). With ``texts`` an entry has a
    field more, ``plain_feed.TEXT``: of a page in the plain form the parser
    reads the head only, and its entries are their texts, all other fields null."""
    if schema is None:
        read = pages.withColumn("_f", F.from_xml(F.col(body_col), HEADER, XML_OPTIONS))
        found = F.lit(None)
    else:
        entry = T.StructType([*schema.fields, *_s(f"_{_OTHER}", *[plain_feed.TEXT] * texts)])
        doc = T.StructType([HEADER["totalResults"], T.StructField("entry", T.ArrayType(entry)), HEADER["_corrupt_record"]])
        body, easy = F.col(body_col), F.col("_easy")
        pages = pages.withColumn("_easy", plain_feed.is_plain(body) if texts else F.lit(False))
        text = body
        if spans is not None:
            pages, text = pages.withColumn("_lean", F.when(~easy, without_spans(body, spans))), F.col("_lean")
        plain = pages.withColumn("_plain", F.when(~easy, plain_markup(text)))
        others = plain.withColumn("_others", foreign_entry_tags(F.col("_plain")))
        text = F.when(easy, plain_feed.head(body)).when(F.size("_others") > 0, _marked(F.col("_plain"), F.col("_others"))).otherwise(text)
        read = others.withColumn("_f", F.from_xml(text, doc, XML_OPTIONS)).drop("_lean", "_plain", "_others")
        mine = F.coalesce(F.filter(F.col("_f.entry"), lambda e: e[f"_{_OTHER}"].isNull()), F.array().cast(T.ArrayType(entry)))
        if texts:
            mine = F.when(easy, plain_feed.entries(body, entry)).otherwise(mine)
        found = F.when(body.isNotNull() & F.col("_f._corrupt_record").isNull(), mine)
    return (read.withColumn("total_results", F.col("_f.totalResults").try_cast("int"))
            .withColumn("parse_ok", F.col(body_col).isNotNull() & F.col("_f._corrupt_record").isNull())
            .withColumn("entries", found).drop("_f", "_easy"))


def plain_markup(body: Column) -> Column:
    """The page without comments and processing instructions, and with CDATA
    sections as escaped text, so that every ``<`` left opens or closes a tag.
    Pages without any of these are passed through."""
    b = F.regexp_replace(body, _HIDDEN, "$1")
    inside = F.transform(F.regexp_extract_all(b, F.lit(_CDATA), F.lit(1)), xml_escape)
    flat = F.array_join(F.zip_with(F.split(b, _CDATA, -1), inside,
                                   lambda out, text: F.concat(out, F.coalesce(text, F.lit("")))), "")
    return F.when(F.contains(body, F.lit("<!")) | F.contains(body, F.lit("<?")), flat).otherwise(body)


def without_spans(body: Column, keep: tuple[str, ...]) -> Column:
    """The page without plain spans of classes other than ``keep``: the parser
    builds a struct with maps of names for every span, which costs far more than
    finding the span. A span goes only if that changes neither the page's form
    nor anything else read off it: it has no child, no unknown entity, and no
    attribute twice, it follows a tag (so no two texts meet), and a tag follows it (so
    nothing behind the root is lost sight of). Any other span stays for the
    parser, and so does a page with comments, CDATA, a DTD or instructions."""
    attr = rf"""\s((?!(?i:class))[A-Za-z]++)="{_VALUE}"(?![^<>]*\s\2\s*=)"""
    span = rf"""<span class="(?!(?:{"|".join(keep)})")\w++"(?:{attr}){{0,8}}+>{_TEXT}</span>"""
    run = rf"""(<(?:/\w++|li|div(?:\sclass="\w*+")?)>)(?:\s*+{span}){{1,{_RUN}}}+(?=\s*+<)"""
    # markup that is not elements, and characters that no page may hold
    other = [F.contains(body, F.lit(s)) for s in ("<!", "<?", "\ufffe", "\uffff")]
    return F.when(reduce(or_, other), body).otherwise(F.regexp_replace(body, run, "$1"))


def _atom_prefixes(tag: Column) -> Column:
    """Prefixes that a start tag binds to Atom (``""``: the default)."""
    prefixes, uris = (F.regexp_extract_all(tag, F.lit(_DECLARED), F.lit(g)) for g in (1, 2))
    bound = F.filter(F.arrays_zip(prefixes.alias("p"), uris.alias("u")), lambda d: d["u"] == F.lit(ATOM))
    return F.transform(bound, lambda d: d["p"])


def foreign_entry_tags(body: Column) -> Column:
    """The page's distinct ``entry`` start tags that are not of the Atom
    namespace: a tag's prefix counts as the tag itself declares it, else as the
    feed does."""
    feed = _atom_prefixes(F.regexp_extract(body, _ROOT, 0))

    def is_atom(tag: Column) -> Column:
        prefix = F.regexp_extract(tag, rf"^<(?:({_NAME}):)?entry", 1)
        own = F.array_contains(F.regexp_extract_all(tag, F.lit(_DECLARED), F.lit(1)), prefix)
        return F.when(own, F.array_contains(_atom_prefixes(tag), prefix)).otherwise(F.array_contains(feed, prefix))

    tags = F.array_distinct(F.regexp_extract_all(body, F.lit(_ENTRY_TAG), F.lit(0)))
    return F.filter(tags, lambda t: ~is_atom(t))


def _marked(body: Column, tags: Column) -> Column:
    """``body`` with an attribute added to each of the start tags ``tags``."""
    name = rf"^(<(?:{_NAME}:)?entry)"
    return F.aggregate(tags, body, lambda text, t: F.replace(
        text, t, F.regexp_replace(t, F.lit(name), F.lit(f'$1 {_OTHER}="1"'))))


def entry_count(body) -> Column:
    """Number of Atom entries of a page, from a parse that builds their ids
    only (0 when the page is not well-formed)."""
    b = plain_markup(F.col(body) if isinstance(body, str) else body)
    doc = T.StructType([T.StructField("entry", T.ArrayType(T.StructType(_s("id", f"_{_OTHER}"))))])
    found = F.from_xml(_marked(b, foreign_entry_tags(b)), doc, XML_OPTIONS)["entry"]
    return F.coalesce(F.size(F.filter(found, lambda e: e[f"_{_OTHER}"].isNull())), F.lit(0)).cast("int")


def explode_entries(parsed: DataFrame, keep: tuple[str, ...] | list) -> DataFrame:
    """One row per entry of parsed pages: ``keep..., entry_pos (1-based),
    entry``. An outer explode and a filter on the position: an inner one would
    push a size test below the parse and so parse twice."""
    return (parsed.select(*keep, F.posexplode_outer("entries").alias("_p", "entry")).filter(F.col("_p").isNotNull())
            .select(*keep, (F.col("_p") + 1).cast("int").alias("entry_pos"), "entry"))


# -- selection helpers: XPath ``x[@class='c']`` on parsed arrays -------------

def first_by_class(arr: Column, cls: str, attr: str = "_VALUE") -> Column:
    """First element of ``arr`` whose ``_class`` is ``cls``; its ``attr``
    (null when none: ``get`` is out-of-range safe under ANSI)."""
    return F.get(F.filter(arr, lambda x: x["_class"] == F.lit(cls)), 0)[attr]


def classes(arr: Column, lower: bool = False) -> Column:
    """``_class`` of every element (one pass, reused by all lookups)."""
    return F.transform(arr, lambda x: F.lower(x["_class"]) if lower else x["_class"])


def pick(arr: Column, class_arr: Column, cls: str, attr: str = "_VALUE") -> Column:
    """First element of ``arr`` whose class is ``cls`` (by position in the
    precomputed ``class_arr``); null when absent."""
    idx = (F.array_position(class_arr, F.lit(cls)) - 1).cast("int")
    return F.get(arr, idx)[attr]


def client_spans(holder: Column) -> Column:
    """Spans of every ``div[@class='client']`` under ``holder``, in order."""
    hit = F.filter(holder["div"], lambda d: (d["_class"] == F.lit("client")) & d["span"].isNotNull())
    return F.flatten(F.transform(hit, lambda d: d["span"]))


def ul_items(entry: Column, cls: str) -> Column:
    """``content/div/ul[@class=cls]/li`` of an entry, of all such lists in
    order (null when the entry has no list at all)."""
    hit = F.filter(entry["content"]["div"]["ul"], lambda u: (u["_class"] == F.lit(cls)) & u["li"].isNotNull())
    return F.flatten(F.transform(hit, lambda u: u["li"]))


def dd_for(li: Column, dl_class: str, term: str) -> Column:
    """The ``dd`` paired (by position) with ``dt = term`` in a definition list."""
    dl = F.get(F.filter(li["dl"], lambda d: d["_class"] == F.lit(dl_class)), 0)
    pairs = F.arrays_zip(dl["dt"].alias("dt"), dl["dd"].alias("dd"))
    return F.get(F.filter(pairs, lambda z: z["dt"] == F.lit(term)), 0)["dd"]
