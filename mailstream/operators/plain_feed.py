"""Entries of pages in the plain form of the feed, as texts.

``from_xml`` builds maps of names for every element that it makes a struct of,
which costs many times the parse itself. Most pages need no parser to tell
where an element ends: they have the elements of the feed and no others,
attributes in double quotes (the class first), text without markup, and no
comments, CDATA, DTD or instructions. ``is_plain`` checks a whole page for that
form, and that it is well-formed, in one match; only then are entries and steps
cut out of the text, and what is looked up in them is searched for in it. Any
other page goes to the parser. Both ways give the same fields (tests compare
them). Literals are split at rather than matched lazily, and many lookups go
through one lambda, not one expression each: the first is the faster search, and
code as long as the second is not compiled by the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that XML forbids, but for two, and CR, which it rewrites.
_FORBIDDEN = "".join(rf"\x{c:02x}" for c in range(32) if c not in (9, 10))
_GAP = r"[ \t\n]*+"
_WORD = rf"[^<>&\]{_FORBIDDEN}]*+"
_TEXT = rf"{_WORD}(?:&(?:amp|lt|gt|quot|apos);{_WORD})*+"
# No "=" in a value, or no blank: so `` name="`` is found in no value.
_VALUE = rf"""(?:[^<>&"=\t\n{_FORBIDDEN}]*+|[^<>&" \t\n{_FORBIDDEN}]*+)(?=")"""

# A class comes first, and is a word, where things are looked up by it.
_CLASS = r'(?: class="\w*+"(?![^<>]* class=)|(?=>))'


class _Form:
    """Builds the pattern of a plain page. The names of an element's attributes
    are a group of their own: none may come twice."""

    def __init__(self):
        self.groups = 0

    def tag(self, name: str, end: str = ">", attr: str = "[A-Za-z]++", value: str = _VALUE) -> str:
        self.groups += 1
        g = f"a{self.groups}"
        return rf"""<{name}(?: (?<{g}>{attr})="{value}"(?![^<>]* \k<{g}>=))*+{end}"""

    def leaf(self, name: str, end: str | None = None) -> str:
        return f"{self.tag(name)}{_TEXT}</{end or name}>"

    def of(self, name: str, *children: str, first: str = "") -> str:
        """An element of ``children``, in any order and number."""
        return rf"{self.tag(name + first)}{_GAP}(?:(?:{'|'.join(children)}){_GAP})*+</{name}>"

    def block(self) -> str:
        """A ``div`` of spans or of text alone."""
        return rf"{self.tag('div' + _CLASS)}(?:{_GAP}(?:{self.leaf('span' + _CLASS, 'span')}{_GAP})++|{_TEXT})</div>"

    def nested(self, name: str, *children: str) -> str:
        """An element with one ``div`` of ``children``."""
        return rf"{self.tag(name)}{_GAP}{self.of('div', *children)}{_GAP}</{name}>"

    def page(self) -> str:
        plain = lambda *names: [f"<{n}>{_TEXT}</{n}>" for n in names]
        li = self.of("li", self.leaf('span' + _CLASS, 'span'), self.block(), self.leaf("abbr" + _CLASS, "abbr"), self.of("dl", *plain("dt", "dd"), first=_CLASS))
        entry = [self.nested("a:content", self.leaf('span' + _CLASS, 'span'), self.of("ul", li, first=_CLASS)), self.nested("a:title", self.leaf('span' + _CLASS, 'span'), self.block()),
                 *plain("a:id", "a:updated", "a:published"), self.tag("a:link", "/>"),
                 f"<a:author>{_GAP}{plain('a:name')[0]}{_GAP}</a:author>"]
        entries = rf"(?:<a:entry>{_GAP}(?:(?:{'|'.join(entry)}){_GAP})*+</a:entry>{_GAP})*+"
        root = self.tag(r'feed(?=[^<>]* xmlns:a="http://www\.w3\.org/2005/Atom")', attr="xmlns(?::[A-Za-z]++)?+")
        total = plain("openSearch:totalResults")[0]
        return rf"\A{root}{_GAP}(?:{total}{_GAP})?+{entries}</feed>\z"


_PAGE = _Form().page()
# More pieces than a text can have; one more than the largest int would overflow.
_ALL = 2 ** 30
#: Field of an entry that holds its text; no XML name, so no page has it.
TEXT = "_plain text"


def is_plain(body: Column) -> Column:
    """True for a well-formed page in the plain form (false without a body)."""
    odd = F.contains(body, F.lit("\ufffe")) | F.contains(body, F.lit("\uffff"))
    return F.coalesce(body.rlike(_PAGE) & ~odd, F.lit(False))


def head(body: Column) -> Column:
    """A plain page without its entries."""
    mark = "<a:entry>"
    return F.when(F.contains(body, F.lit(mark)), F.concat(F.substring_index(body, mark, 1), F.lit("</feed>"))).otherwise(body)


def entries(body: Column, schema: T.StructType) -> Column:
    """The entries of a plain page: structs of ``schema`` of which only
    ``TEXT``, an entry's text, is there."""
    texts = F.slice(F.split(F.get(F.split(body, "</feed>"), F.lit(0)), "<a:entry>", -1), 2, _ALL)
    return F.transform(texts, lambda e: F.struct(*[
        (e if f.name == TEXT else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]))


def text_of(df: DataFrame, entry: str = "entry") -> Column | None:
    """The text of a row's entry (null for one that the parser made), or None
    where all entries are the parser's."""
    return F.col(entry)[TEXT] if TEXT in df.schema[entry].dataType.fieldNames() else None


def either(text: Column | None, plain, parsed: Column) -> Column:
    """``plain(text)`` where there is a text, else ``parsed``."""
    return parsed if text is None else F.when(text.isNotNull(), plain(text)).otherwise(parsed)


def _pieces(text: Column, name: str) -> Column:
    """``text`` cut at the tags of elements ``name``, which do not nest: what is
    outside them at even places, what is inside (from the attributes on) at odd
    ones. A literal is split at many times faster than a pattern finds pairs."""
    return F.split(text, f"</?{name}(?=[ >])", -1)


def _outside(text: Column, name: str) -> Column:
    return F.array_join(F.filter(_pieces(text, name), lambda x, i: i % 2 == 0), "")


def _first(text: Column, sign: str) -> Column:
    """What precedes the first ``sign``."""
    return F.get(F.split(text, sign, 2), F.lit(0))


def _last(text: Column, sign: str) -> Column:
    """What follows the last ``sign``; null without one."""
    return F.try_element_at(F.slice(F.split(text, sign, -1), 2, _ALL), F.lit(-1))


def parent_text(e: Column) -> Column:
    """An entry's text without its lists."""
    return _outside(e, "ul")


def items(e: Column, cls: str) -> Column:
    """The items of an entry's lists of class ``cls``, each from its
    attributes on. Of contents the parser too takes the last."""
    lists = F.slice(F.split(_last(e, "<a:content"), f'<ul class="{cls}"', -1), 2, _ALL)
    found = F.transform(lists, lambda u: F.slice(F.split(_first(u, "</ul>"), "<li(?=[ >])", -1), 2, _ALL))
    return F.coalesce(F.flatten(found), F.array().cast("array<string>"))


def own(text: Column) -> Column:
    """Without ``div`` elements."""
    return _outside(text, "div")


def client(text: Column) -> Column:
    """What is inside all ``div`` elements of class ``client``."""
    return F.array_join(F.filter(_pieces(text, "div"), lambda x, i: (i % 2 == 1) & F.startswith(x, F.lit(' class="client"'))), "")


def title(parent: Column) -> Column:
    """Inside the ``div`` of an entry's (last) title; null without one."""
    inner = F.split(_first(_last(parent, "<a:title"), "</a:title>"), "<div(?=[ >])", 2)
    return F.regexp_replace(F.get(inner, F.lit(1)), r"</div>[ \t\n]*+\z", "")


def leaf(text: Column, cls: str, name: str = "span") -> Column:
    """The first element ``name`` of the class, from its other attributes up to
    the end of its text (blank: there is none)."""
    return F.regexp_extract(text, f'<{name} class="{cls}"([^<]*+)', 1)


def _signs(s: Column) -> Column:
    clear = s
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        clear = F.replace(clear, F.lit(f"&{name};"), F.lit(sign))
    return F.when(F.contains(s, F.lit("&")), clear).otherwise(s)


def text_(raw: Column) -> Column:
    """Character data as the parser gives it, without blanks around it."""
    return F.get(_cleared(F.array(raw)), F.lit(0))


def _cleared(found: Column) -> Column:
    """Every text of an array, by ``text_``. One lambda for all of them: as many
    expressions would make code that the JVM does not compile."""
    return F.transform(F.transform(found, lambda x: F.btrim(x, F.lit(" \t\n"))), _signs)


def values(leaves: Column) -> Column:
    """The text of each ``leaf`` of an array; null when blank."""
    texts = _cleared(F.transform(leaves, lambda x: F.substring_index(x, ">", -1)))
    return F.transform(texts, lambda x: F.when(x != F.lit(""), x))


def attr(raw: Column, name: str) -> Column:
    """An attribute of a ``leaf``; null when it has none of that name."""
    mark = f' {name}="'
    found = F.btrim(F.substring_index(F.substring_index(raw, mark, -1), '"', 1), F.lit(" "))
    return F.when(F.contains(F.substring_index(raw, ">", 1), F.lit(mark)), found)


def last(parent: Column, name: str) -> Column:
    """The text of an entry's (last) Atom element ``name`` as it stands, null
    without the element."""
    return F.get(F.split(_last(parent, f"<a:{name}>"), "<", 2), F.lit(0))


def atoms(found: Column) -> Column:
    """The texts of an array of ``last``."""
    return _cleared(found)


def in_content(parent: Column) -> Column:
    """The (last) content of an entry without its lists."""
    return _first(_last(parent, "<a:content"), "</a:content>")


def term(text: Column, cls: str, name: str) -> Column:
    """The ``dd`` paired by position with the first ``dt`` that says ``name``,
    in the first definition list of the class."""
    terms = _first(F.get(F.split(text, f'<dl class="{cls}"', 3), F.lit(1)), "</dl>")
    dt, dd = (F.regexp_extract_all(terms, F.lit(f"<{n}>([^<]*+)"), F.lit(1)) for n in ("dt", "dd"))
    at = F.array_position(F.transform(dt, text_), F.lit(name))
    raw = F.get(dd, (at - 1).cast("int"))
    return F.when(at > 0, text_(raw))
