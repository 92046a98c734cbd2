"""Pages in the plain form are read off the text; the parser is the model."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mailstream.operators import parcels as P
from mailstream.operators import plain_feed

ROOT = ('<feed xmlns="http://www.w3.org/1999/xhtml" xmlns:a="http://www.w3.org/2005/Atom" '
        'xmlns:openSearch="http://a9.com/-/spec/opensearch/1.1/">')
WORDS = ["", " ", "x", " two  words ", "a&lt;b&gt; &amp;lt; &quot;q&apos;", "triSanctionPartiel", " triSanctionPartiel", "é€😀", "1=2", "\n t\tu \n", "&amp;", " "]
VALUES = ["", " ", "v", " v w ", "é", "a=b", "'"]
CLASSES = {"ul": ["traitement", "traitementManuel", "traitement", "traitementManuel", "adresses"], "div": ["client", "client", "expires"], "dl": ["parametresTri"],
           "abbr": ["programmeTri", "other"]}
SPANS = ["id", "id", "datePublication", "datePublication", "format", "priorite", "etat", "cleExterne", "derivation", "dateDebut", "idPlateforme", "receptacle", "receptacle",
         "receptacleReel", "receptacleReel", "cedex", "Cedex", "CEDEX", "service", "date", "type", "duree", "raisonFin", "unknown", "", "idMachineTri"]
NAMES = ["class", "title", "type", "niveau", "lang", "id", "rel", "other"]
LINKS = ["", ' href="http://x/i?format=jpeg"', ' href="http://x/i?format=png"', ' alt="format=jpeg"']


class Pages:
    """Random pages, most of them plain."""

    def __init__(self, seed):
        self.r = random.Random(seed)

    def some(self, made, most=3):
        return self.gap().join(made() for _ in range(self.r.randrange(most + 1)))

    def gap(self):
        return self.r.choice(["", "", "", "\n", " \t"])

    def attrs(self, name=""):
        names = self.r.sample(NAMES[1:], self.r.choice([0, 0, 0, 1, 2, 5]))
        first = self.r.choice(CLASSES.get(name, SPANS))
        known = f' class="{first}"' if self.r.random() < .95 else ""
        return known + "".join(f' {n}="{self.r.choice(VALUES)}"' for n in names if known or name not in ("span", "div", "ul", "dl", "abbr"))

    def leaf(self, name):
        return f"<{name}{self.attrs(name)}>{self.r.choice(WORDS)}</{name}>"

    def bare(self, name):
        return f"<{name}>{self.r.choice(WORDS)}</{name}>"

    def of(self, name, *made):
        inner = self.some(lambda: self.r.choice(made)(), 6)
        return f"<{name}{self.attrs(name)}>{self.gap()}{inner}{self.gap()}</{name}>"

    def span(self):
        return self.leaf("span")

    def div(self):
        return self.leaf("div") if self.r.random() < .3 else self.of("div", self.span)

    def dl(self):
        return self.of("dl", lambda: self.bare("dt"), lambda: self.bare("dd"))

    def li(self):
        return self.of("li", self.span, self.span, self.div, self.dl, lambda: self.leaf("abbr"))

    def nested(self, name, *made):
        return f"<{name}{self.attrs()}>{self.gap()}{self.of('div', *made)}{self.gap()}</{name}>"

    def entry(self):
        parts = [lambda: self.nested("a:title", self.span, self.div), lambda: self.nested("a:content", self.span, lambda: self.of("ul", self.li)),
                 *[lambda n=n: self.bare(n) for n in ("a:id", "a:updated", "a:published")],
                 lambda: f"<a:link{self.attrs()}{self.r.choice(LINKS)}/>", lambda: f"<a:author>{self.gap()}{self.bare('a:name')}</a:author>"]
        self.r.shuffle(parts)
        made = [p() for p in parts if self.r.random() < .85] + [p() for p in parts[:2] if self.r.random() < .15]
        return f"<a:entry>{self.gap()}{self.gap().join(made)}</a:entry>{self.gap()}"

    def page(self):
        total = self.r.choice(["", "<openSearch:totalResults>7</openSearch:totalResults>", "<openSearch:totalResults>x</openSearch:totalResults>"])
        return ROOT + self.gap() + total + self.some(self.entry, 4) + "</feed>"

    def spoilt(self):
        """A page with one to three signs changed: hardly ever plain, often
        not well-formed, sometimes with other namespaces."""
        p = self.page()
        for _ in range(self.r.randrange(1, 4)):
            i = self.r.randrange(len(p))
            p = self.r.choice([
                lambda: p[:i] + p[i + 1:],
                lambda: p[:i] + self.r.choice(["<", ">", "&", '"', "'", "=", "/", " ", "]", "]]>", "\r", "\x01", "￾", "&#65;", "&nbsp;", "<!-- -->", "<?x y?>",
                                               "<br/>", "<a:entry>", "</a:entry>", "<![CDATA[<li>]]>", ' class="x"', "a:", "<span>", "</span>"]) + p[i:],
                lambda: re.sub(r"<(\w+)", r"<\1 class='q'", p, count=1),
                lambda: p.replace("<a:entry>", '<a:entry xmlns:a="urn:other">', 1),
                lambda: p.replace(' xmlns:a="http', ' xmlns:b="http', 1),
                lambda: p.replace(">", "><x/>", 1),
                lambda: p + self.r.choice(["x", "\n", "<!-- -->"]),
            ])()
        return p


def both_ways(df, monkeypatch, read):
    fast = sorted(map(repr, read(df).collect()))
    with monkeypatch.context() as m:
        m.setattr(plain_feed, "is_plain", lambda body: F.lit(False))
        return fast, sorted(map(repr, read(df).collect()))


def jsons(df):
    p = P.parcels(P.entries(df, texts=True))
    return p.select("url", "entry_pos", "kind", "li_pos", P.parcel_json(p).alias("value"))


READERS = {
    "parcels": lambda df: P.parcels(P.entries(df, texts=True)), "machine": lambda df: P.machine_parcels(P.entries(df, texts=True)),
    "manual": lambda df: P.manual_parcels(P.entries(df, texts=True)), "json": jsons}


@pytest.mark.parametrize("name", READERS)
def test_plain_pages_are_read_as_the_parser_reads_them(spark, monkeypatch, name):
    made = Pages(11)
    rows = [(f"u{i}", 200, made.page() if i < 80 else made.spoilt()) for i in range(160)] + [
        ("none", 200, None), ("empty", 200, ""), ("bare", 200, ROOT + "</feed>"), ("gone", 404, made.page())]
    df = spark.createDataFrame(rows, "url string, status int, body string").repartition(4)
    plain = {r["url"] for r in df.filter(plain_feed.is_plain(F.col("body"))).collect()}
    assert {f"u{i}" for i in range(80)} <= plain and "none" not in plain and len(plain) < 120
    fast, slow = both_ways(df, monkeypatch, READERS[name])
    assert fast == slow and len(fast) > 80


def test_pages_that_are_not_well_formed_are_not_plain(spark):
    """Each differs from a plain page by one thing that XML forbids or that
    the text alone does not tell."""
    def page(inside, root=ROOT, end="</feed>"):
        return f"{root}<a:entry><a:content><div><ul class=\"u\"><li>{inside}</li></ul></div></a:content></a:entry>{end}"

    good = '<span class="id">v</span>'
    odd = [page(x) for x in ('<span class="id" class="x">v</span>', '<span class="id">v</div>', '<span class="id">a & b</span>', '<span class="id">]]></span>',
                             '<span class="i<d">v</span>', "<span class='id'>v</span>", '<span class="id">&#x41;</span>', '<span class="id">&nbsp;</span>', "<span>a\rb</span>",
                             "<span>\x02</span>", "<span>￿</span>", "<span><b>v</b></span>", "text", "<!-- -->", '<p class="id">v</p>', '<span class="a title=" x="b">v</span>')]
    odd += [page(good, end="</feed>x"), page(good, end="</feed><feed/>"), page(good, end=""), page(good, ROOT.replace("2005/Atom", "2005/Else")), page(good) * 2,
            page(good, ROOT.replace(">", ' xmlns="urn:x">')), page(good).replace("<a:entry>", '<a:entry xml:lang="fr">')]
    df = spark.createDataFrame([(page(good), True), *[(x, False) for x in odd]], "body string, want boolean")
    assert df.filter(plain_feed.is_plain(F.col("body")) != F.col("want")).collect() == []


def test_rendered_pages_are_plain_and_their_messages_the_same(spark, sf_small, monkeypatch):
    from mailstream.plans.queries import rendered_pages
    df = rendered_pages(spark, sf_small).select("url", "status", "body")
    assert df.filter(~plain_feed.is_plain(F.col("body"))).count() == 0
    fast, slow = both_ways(df, monkeypatch, READERS["json"])
    assert fast == slow and fast
