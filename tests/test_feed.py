"""Hand-written feeds for the parsing and routing rules."""

import json

from pyspark.sql import functions as F

from mailstream.operators import feed as fd
from mailstream.operators import messages as msg
from mailstream.operators import parcels as P

NS = ('xmlns="http://www.w3.org/1999/xhtml" xmlns:a="http://www.w3.org/2005/Atom" '
      'xmlns:openSearch="http://a9.com/-/spec/opensearch/1.1/"')


def feed(*entries, total="1", prefix="a"):
    p = f"{prefix}:" if prefix else ""
    head = f'<feed {NS}>' + (f"<openSearch:totalResults>{total}</openSearch:totalResults>"
                              if total is not None else "")
    return head + "".join(e.replace("<a:", f"<{p}").replace("</a:", f"</{p}") for e in entries) + "</feed>"


def spans(values, **attrs):
    """Spans of ``class -> value`` in alphabetical order; ``attrs`` maps a
    class to more attributes."""
    return "".join(f'<span class="{c}"{attrs.get(c, "")}>{v}</span>' for c, v in sorted(values.items()))


def client(values, **attrs):
    return f'<div class="client">{spans(values, **attrs)}</div>'


def machine(date_pub="2031-03-05T07:11:41Z", cedex_class="Cedex", dl="<dt>triSanctionPartiel</dt><dd>0</dd>",
            date_debut="2031-03-05T07:10:02Z", etat="DONE"):
    own = {"dateDebut": date_debut, "idMachineTri": "M77", "entreeMachine": "in-4", "idPlateforme": "PF1", "etat": etat,
           "receptacle": "B3", "plateformeSuivante": "PF2", "valeur_adresse_prioritaire": "V9",
           "type_adresse_prioritaire": "zone", cedex_class: "non", "service": "NONE", "datePublication": date_pub}
    real = client({"receptacleReel": "R9", "raisonModificationReceptacle": "FULL"},
                  receptacleReel=' lang="en" title="t" niveau="2"')
    return ("<li>" + real + spans(own, receptacle=' niveau="7" lang="fr" title="0" type="FINAL"')
            + f'<dl class="parametresTri">{dl}</dl><abbr id="8" title="P-1" class="programmeTri">Out</abbr></li>')


def manual(date_pub="2031-03-06T10:00:00Z", date="2031-03-06T09:00:00Z"):
    operator = {"idCentreVideocodage": "CV1", "duree": "12", "nomOperateur": "op", "datePublication": date_pub,
                "sequenceFrappe": "3", "raisonFin": "END"}
    return "<li>" + client(operator) + spans({"date": date, "type": "VIDEO", "etat": "FINI"}, etat=' title="OK"') + "</li>"


def address(i):
    return ("<li>" + client({"codeAcheDistri": f"D{i}"})
            + spans({"type": "SCAN", "code": f"C{i}", "idRao": f"R{i}", "typeRao": "stops"}) + "</li>")


def entry(isie, machines=(), manuals=(), addresses=0, updated="2031-03-06T12:30:45Z",
          published="2031-03-05T07:10:03Z", link=None):
    lists = [("adresses", [address(i) for i in range(addresses)]), ("traitementManuel", manuals), ("traitement", machines)]
    uls = "".join(f'<ul class="{c}">{"".join(items)}</ul>' for c, items in lists if items)
    head = ('<div class="expires">non</div>' + client({"cleExterne": "EXT"})
            + spans({"format": "PF", "etat": "CREE", "priorite": "Slow", "id": isie}, id=' title="imp"'))
    link_xml = f'<a:link href="{link}" rel="alternate"/>' if link else ""
    return (f"<a:entry><a:published>{published}</a:published><a:updated>{updated}</a:updated>{link_xml}"
            f'<a:content type="xhtml"><div>{uls}{spans({"derivation": "DER"})}</div></a:content>'
            f'<a:author><a:name>author-1</a:name></a:author><a:id>urn:{isie}</a:id>'
            f'<a:title type="xhtml"><div>{head}</div></a:title></a:entry>')


def pages(spark, *bodies, status=200):
    rows = [(f"u{i}", status, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "url string, status int, body string")


def test_machine_steps_and_address(spark):
    df = pages(spark, feed(entry("X1", machines=[machine(), machine("2031-04-09T21:14:07Z")],
                                 addresses=1)))
    ents = P.entries(df)
    m = P.machine_parcels(ents).orderBy("li_pos").collect()
    assert [r["li_pos"] for r in m] == [1, 2]
    r = m[0]
    assert (r["isie"], r["format"], r["priorite"], r["etat"], r["t_etat"]) == \
        ("X1", "PF", "Slow", "CREE", "DONE")
    assert (r["plateformTri"], r["envoloppeExpire"], r["cleExterne"], r["derivationAdresse"]) == \
        ("author-1", "non", "EXT", "DER")
    assert (r["programmeTriTitle"], r["programmeTriId"], r["programmeTri"]) == ("P-1", "8", "Out")
    assert (r["receptacle"], r["receptacleType"], r["receptacleNiveau"], r["receptacleLang"]) == \
        ("B3", "FINAL", "7", "fr")
    assert (r["receptacleReel"], r["receptacleReelNiveau"], r["receptacleReelTitle"],
            r["receptacleReelLang"], r["raisonModificationReceptacle"]) == ("R9", "2", "t", "en", "FULL")
    assert r["cedex"] == "non"                       # class "Cedex" matches (case-insensitive)
    assert r["triSanctionPartiel"] == "0"
    a = P.addresses(ents).collect()
    assert len(a) == 1 and (a[0]["CodeAdresse"], a[0]["codeAcheDistri"], a[0]["idRao"]) == ("C0", "D0", "R0")


def test_manual_steps_and_union_order(spark):
    df = pages(spark, feed(entry("X2", machines=[machine()], manuals=[manual(), manual("2031-04-10T00:00:00Z")])))
    ents = P.entries(df)
    h = P.manual_parcels(ents).orderBy("li_pos").collect()
    assert [r["datePublication"] for r in h] == ["2031-03-06T10:00:00Z", "2031-04-10T00:00:00Z"]
    assert (h[0]["status"], h[0]["t_etat"], h[0]["duree"], h[0]["sequenceFrappe"]) == ("OK", "FINI", "12", "3")
    allp = P.parcels(ents).collect()
    assert sorted((r["kind"], r["li_pos"]) for r in allp) == \
        [("machine", 1), ("manuel", 1), ("manuel", 2)]
    assert {r["id"] for r in allp} == {"2031-03-05T07:11:41Z", "2031-03-06T10:00:00Z", "2031-04-10T00:00:00Z"}
    counts = P.treatment_counts(ents).first()
    assert (counts["n_machine"], counts["n_manual"]) == (1, 2)


def test_entry_without_steps_yields_nothing(spark):
    df = pages(spark, feed(entry("E0"), entry("E1", machines=[machine()])))
    ents = P.entries(df)
    assert [r["entry_pos"] for r in ents.collect()] == [1, 2]
    p = P.parcels(ents).collect()
    assert [(r["isie"], r["entry_pos"]) for r in p] == [("E1", 2)]
    c = {r["isie"]: (r["n_machine"], r["n_manual"]) for r in P.treatment_counts(ents).collect()}
    assert c == {"E0": (0, 0), "E1": (1, 0)}


def test_partial_sort_value_is_paired_with_its_term(spark):
    dl = "<dt>lot</dt><dd>5</dd><dt>triSanctionPartiel</dt><dd>1</dd>"
    df = pages(spark, feed(entry("L", machines=[machine(dl=dl, cedex_class="cedex")])))
    r = P.machine_parcels(P.entries(df)).first()
    assert r["triSanctionPartiel"] == "1" and r["cedex"] == "non"


def test_blank_times_become_null_and_key_prints_null(spark):
    df = pages(spark, feed(entry("B", machines=[machine(date_pub="", date_debut="")],
                                 manuals=[manual(date="", date_pub="")], updated="", published="")))
    ents = P.entries(df)
    p = P.with_keys(P.parcels(ents)).collect()
    for r in p:
        assert r["updated"] is None and r["published"] is None and r["id"] is None
        assert r["key"] == "B|null"
    m = [r for r in p if r["kind"] == "machine"][0]
    h = [r for r in p if r["kind"] == "manuel"][0]
    assert m["machine"]["debutTraitement"] is None and h["manuel"]["date"] is None
    out = msg.page_messages(df).collect()
    assert len(out) == 1                      # same key twice in a page: last wins
    j = json.loads(out[0]["value"])
    assert "updated" not in j and "published" not in j
    assert j["traitement"]["type"] == "VIDEO"  # the manual step came last
    assert "date" not in j["traitement"] and "datePublication" not in j["traitement"]


def test_last_value_wins_per_page(spark):
    same = "2031-04-12T00:00:00Z"
    df = pages(spark, feed(entry("K", machines=[machine(same, etat="FIRST"), machine(same, etat="SECOND")])),
               feed(entry("K", machines=[machine(same, etat="OTHER")])))
    out = {(r["key"], r["value"]) for r in msg.page_messages(df).collect()}
    states = sorted(json.loads(v)["traitement"]["etat"] for _, v in out)
    assert states == ["OTHER", "SECOND"]          # one per page; in page u0 the later step
    keyed = P.with_keys(P.parcels(P.entries(df)))
    last = P.last_per_key(keyed).collect()
    assert sorted((r["url"], r["li_pos"], r["machine"]["etat"]) for r in last) == [("u0", 2, "SECOND"), ("u1", 1, "OTHER")]


def test_last_value_over_entries_and_kinds(spark):
    """Against a map filled in document order: entries that share their id,
    machine and manual steps of one date, null dates."""
    import random
    rnd = random.Random(5)
    dates = ["2031-05-01T00:00:00Z", "2031-05-02T00:00:00Z", ""]
    bodies, want = [], set()
    for u in range(4):
        filled, ents = {}, []
        for e in range(12):
            isie = f"S{rnd.randrange(4)}"
            ms = [rnd.choice(dates) for _ in range(rnd.randrange(4))]
            hs = [rnd.choice(dates) for _ in range(rnd.randrange(3))]
            ents.append(entry(isie, [machine(d) for d in ms], [manual(d) for d in hs]))
            for kind, ds in (("machine", ms), ("manuel", hs)):
                for k, d in enumerate(ds):
                    filled[f"{isie}|{d or 'null'}"] = (e + 1, kind, k + 1)
        bodies.append(feed(*ents))
        want |= {(f"u{u}", key, *place) for key, place in filled.items()}
    df = pages(spark, *bodies)
    keyed = P.with_keys(P.step_keys(P.key_entries(df))).select("url", "key", "entry_pos", "kind", "li_pos")
    assert {tuple(r) for r in P.last_per_key(keyed).collect()} == want
    places = msg.page_messages(df).select("url", "key").collect()
    assert sorted(map(tuple, places)) == sorted((u, k) for u, k, *_ in want)


def test_image_flag_from_links(spark):
    df = pages(spark, feed(entry("I1", machines=[machine()], link="http://x/i?format=jpeg"),
                           entry("I2", machines=[machine()], link="http://x/i?format=png"),
                           entry("I3", machines=[machine()])))
    got = {r["isie"]: r["image"] for r in P.parcels(P.entries(df)).collect()}
    assert got == {"I1": True, "I2": False, "I3": False}


def test_totals_and_empty_feeds(spark):
    bodies = [feed(total="0"), feed(entry("A", machines=[machine()]), total="1"),
              feed(total="1000"), feed(total="1001"), feed(total=None)]
    df = fd.parse_header(pages(spark, *bodies))
    got = [(r["total_results"], r["parse_ok"]) for r in df.orderBy("url").collect()]
    assert got == [(0, True), (1, True), (1000, True), (1001, True), (None, True)]
    assert P.entries(pages(spark, feed(total="0"))).count() == 0
    n = df.select(fd.entry_count("body").alias("n")).orderBy("url").collect()
    assert [r["n"] for r in n] == [0, 1, 0, 0, 0]


def test_bad_xml_and_failed_fetch_go_to_dead_letter(spark):
    good = feed(entry("G", machines=[machine()]))
    df = spark.createDataFrame([("ok", 200, good), ("trunc", 200, good[:300]),
                                ("gone", 404, None), ("err", 500, "boom")],
                               "url string, status int, body string")
    out = {r["url"]: r for r in msg.page_messages(df).collect()}
    assert out["ok"]["topic"] == msg.PARCELS_TOPIC and out["ok"]["key"] == "G|2031-03-05T07:11:41Z"
    assert (out["trunc"]["topic"], out["trunc"]["reason"], out["trunc"]["value"]) == \
        (msg.CATCH_URLS_TOPIC, "parse_error", "trunc")
    assert out["gone"]["reason"] == "http_404" and out["err"]["reason"] == "http_500"
    # a truncated page yields no parcels at all (a page is all or nothing)
    assert P.entries(df.filter(F.col("url") == "trunc")).count() == 0


ATOM = "http://www.w3.org/2005/Atom"


def isies(spark, *bodies):
    """Per page: (position, isie) of every parcel's entry."""
    got = P.parcels(P.entries(pages(spark, *bodies))).select("url", "entry_pos", "isie").distinct().collect()
    return [sorted((r["entry_pos"], r["isie"]) for r in got if r["url"] == f"u{i}") for i in range(len(bodies))]


def test_any_prefix_of_the_atom_namespace_counts(spark):
    declared = feed(entry("P1", machines=[machine()]), prefix="atom").replace("xmlns:a=", "xmlns:atom=")
    default = feed(entry("P2", machines=[machine()]), prefix="").replace('xmlns="http://www.w3.org/1999/xhtml"', f"xmlns='{ATOM}'")
    own = feed(entry("P3", machines=[machine()]).replace("<a:entry>", f'<z:entry xml:lang="en" xmlns:z="{ATOM}">')
               .replace("</a:entry>", "</z:entry>"))
    assert isies(spark, declared, default, own) == [[(1, "P1")], [(1, "P2")], [(1, "P3")]]


def test_an_entry_of_another_namespace_is_no_entry(spark):
    """The default namespace in scope decides about an unprefixed tag; a
    prefix bound elsewhere, or bound anew on the tag itself, decides too."""
    one, two, ghost = (entry(x, machines=[machine()]) for x in ("N1", "N2", "GHOST"))
    plain = ghost.replace("a:entry", "entry")
    xhtml = feed(one, plain, two)
    lone = feed(plain)
    rebound = feed(ghost.replace("<a:entry>", '<a:entry xmlns:a="urn:other">'), one, two)
    unbound = feed(one, ghost.replace("a:entry", "q:entry"), two)
    inline = feed(plain.replace("<entry>", f'<entry xmlns="{ATOM}" title="a > b">'), one)
    assert isies(spark, xhtml, lone, rebound, unbound, inline) == [
        [(1, "N1"), (2, "N2")], [], [(1, "N1"), (2, "N2")], [(1, "N1"), (2, "N2")], [(1, "GHOST"), (2, "N1")]]
    df = pages(spark, xhtml, lone)
    assert [r["n"] for r in df.select(fd.entry_count("body").alias("n")).collect()] == [2, 0]
    out = msg.page_messages(df).collect()
    assert len(out) == 2 and {r["topic"] for r in out} == {msg.PARCELS_TOPIC}


def test_only_children_of_the_feed_are_entries(spark):
    one, two, ghost = (entry(x, machines=[machine()]) for x in ("N1", "N2", "GHOST"))
    inside = feed(one.replace("<a:content", f"<a:source>{ghost}</a:source><a:content"), two)
    in_content = feed(one.replace('<span class="derivation">', f"{ghost}<span class='derivation'>"), two)
    below = feed(f"<a:section>{ghost}</a:section>", one, f"<div><p>{ghost}</p></div>", two)
    want = [(1, "N1"), (2, "N2")]
    assert isies(spark, inside, in_content, below) == [want] * 3
    assert [r["parse_ok"] for r in fd.parse_feed(pages(spark, inside, in_content, below)).collect()] == [True] * 3


def test_entries_are_elements_of_the_feed(spark):
    """Comments, CDATA and instructions hold no entries; every Atom prefix
    counts, and a foreign namespace's ``entry`` does not."""
    one, two = entry("N1", machines=[machine()]), entry("N2", machines=[machine()])
    ghost = entry("GHOST", machines=[machine()])
    commented = feed(one, "<!-- " + ghost + " -->", two)
    cdata = feed(one.replace("<a:id>", "<a:id><![CDATA[" + ghost + " & more]]>"), two)
    told = feed(one, "<?note " + ghost + "?>", two)
    nested = feed(one, "<!-- <![CDATA[ -->", two, "<!-- ]]> -->")
    second = feed(one, two.replace("<a:", "<b:").replace("</a:", "</b:")).replace("<feed ", f'<feed xmlns:b="{ATOM}" ')
    foreign = feed(ghost.replace("<a:", "<x:").replace("</a:", "</x:"), one, two).replace("<feed ", "<feed xmlns:x='urn:other' ")
    df = pages(spark, commented, cdata, told, nested, second, foreign)
    got = sorted((r["url"], r["entry_pos"], r["isie"]) for r in P.parcels(P.entries(df)).collect())
    assert got == [(f"u{i}", k, f"N{k}") for i in range(6) for k in (1, 2)]
    assert [r["n"] for r in df.select(fd.entry_count("body").alias("n")).collect()] == [2] * 6
    out = msg.page_messages(df).collect()
    assert len(out) == 12 and {r["topic"] for r in out} == {msg.PARCELS_TOPIC}


def test_json_layout(spark):
    df = pages(spark, feed(entry("J", machines=[machine()])))
    v = msg.page_messages(df).first()["value"]
    j = json.loads(v)
    assert list(j) == ["isie", "image", "format", "priorite", "etat", "plateformTri",
                       "envoloppeExpire", "cleExterne", "updated", "published",
                       "derivationAdresse", "traitement"]
    assert list(j["traitement"])[:3] == ["debutTraitement", "idPlateforme", "idMachineTri"]
    assert j["traitement"]["cedex"] == "non"


def test_json_escapes(spark):
    odd = "a<b>&c='d'\u2028e\u2029f"
    row = spark.createDataFrame([(odd,)], "v string").select(P.html_safe(F.to_json(F.struct("v"))).alias("j")).first()
    assert row["j"] == '{"v":"a\\u003cb\\u003e\\u0026c\\u003d\\u0027d\\u0027\\u2028e\\u2029f"}' and json.loads(row["j"])["v"] == odd


def test_page_map_round_trip(spark):
    df = pages(spark, feed(entry("M", machines=[machine()], manuals=[manual()])))
    kv = msg.page_messages(df).select("url", "key", "value")
    back = msg.explode_result_map(msg.page_result_map(kv))
    assert sorted(back.collect()) == sorted(kv.collect())


def test_loose_layout_empty_blocks_and_unknown_elements(spark):
    """Line breaks and tabs around every tag, empty elements, unknown lists,
    unknown attributes: the listed fields come out all the same."""
    step = machine(cedex_class="CEDEX").replace('<div class="client">', '<div class="client"/><hr/><div class="client" id="k">')
    odd = (entry("LOOSE", machines=[step], addresses=1, link="https://pics.invalid/1?x=1&amp;format=jpeg")
           .replace("</ul>", '</ul><ul class="journal"><li>just text</li><li/></ul><ul/>')
           .replace("<li>", "<li data-rank='9' class='row'>"))
    loose = feed("<!-- layout -->", odd).replace("><", ">\n\t <")
    rows = [r.asDict(recursive=True) for r in P.parcels(P.entries(pages(spark, loose, feed(odd)))).orderBy("url").collect()]
    assert len(rows) == 2
    for r in rows:
        assert (r["isie"], r["format"], r["plateformTri"], r["image"]) == ("LOOSE", "PF", "author-1", True)
        assert set(r["machine"]) == set(P.MACHINE_FIELDS) and all(v is not None for v in r["machine"].values())
        assert (r["machine"]["cedex"], r["machine"]["receptacleReelNiveau"]) == ("non", "2")
    assert {**rows[0], "url": ""} == {**rows[1], "url": ""}
    empty = feed(entry("E", machines=["<li/>", "<li><div class='client'/></li>"]))
    blank = P.parcels(P.entries(pages(spark, empty))).collect()
    assert all(v is None for r in blank if r["machine"] for v in r["machine"].asDict().values())


def test_pruned_key_parse_equals_full_parse(spark):
    """Keys, step counts and addresses from the pruned schema equal those
    from the full parse, including blank dates, manual steps, entries
    without steps and missing lists."""
    body = feed(entry("K1", machines=[machine(), machine(date_pub="")], manuals=[manual()], addresses=2),
                entry("K2"),
                entry("K3", manuals=[manual(date_pub=""), manual("2031-04-10T00:00:00Z")]),
                entry("K4", machines=[machine(cedex_class="cedex")], addresses=1),
                total="4")
    df = pages(spark, body)
    full, pruned = P.entries(df), P.key_entries(df)
    cols = ["url", "entry_pos", "kind", "li_pos", "key"]
    want = P.with_keys(P.parcels(full)).select(*cols).collect()
    got = P.with_keys(P.step_keys(pruned)).select(*cols).collect()
    assert sorted(got) == sorted(want) and len(want) == 6
    assert any(r["key"].endswith("|null") for r in got)
    assert sorted(P.treatment_counts(pruned).collect()) == sorted(P.treatment_counts(full).collect())
    assert sorted(P.addresses(pruned).collect()) == sorted(P.addresses(full).collect())


def test_two_lists_and_two_client_blocks_are_all_read(spark):
    """Steps of every matching list, in order; spans of every client block."""
    two = entry("T2", machines=[machine(), machine(date_pub="2031-03-05T08:00:00Z")])
    first, second = machine(), machine(date_pub="2031-03-05T08:00:00Z")
    split = entry("T2", machines=[first, second]).replace("</li><li>", '</li></ul><ul class="traitement"><li>', 1)
    block = '</span><span class="raisonModificationReceptacle">'
    split_client = two.replace(block, '</span></div><div class="client"><span class="raisonModificationReceptacle">')
    feed = lambda e: ('<a:feed xmlns:a="http://www.w3.org/2005/Atom">' + e + "</a:feed>")
    from mailstream.operators.parcels import entries, parcels
    df = spark.createDataFrame([(f"u{i}", 200, feed(e)) for i, e in enumerate([two, split, split_client])],
                               "url string, status int, body string")
    rows = {}
    for r in parcels(entries(df)).orderBy("url", "li_pos").collect():
        rows.setdefault(r["url"], []).append(str(r.asDict(True)).replace(f"'{r['url']}'", ""))
    assert len(rows["u0"]) == 2 and rows["u0"] == rows["u1"] == rows["u2"]


def test_the_failed_lane_alone_equals_the_failed_lane_of_all(spark):
    """``failed_only`` builds no entries and gives the same dead letters."""
    good = feed(entry("F1", machines=[machine()], manuals=[manual()]))
    df = pages(spark, good, "<feed><entry>cut", feed(), None).unionByName(
        spark.createDataFrame([("busy", 503, good), ("none", None, None)], "url string, status int, body string"))
    whole = msg.page_messages(df).filter(F.col("topic") == msg.CATCH_URLS_TOPIC)
    assert sorted(msg.page_messages(df, failed_only=True).collect()) == sorted(whole.collect())
    assert whole.count() == 4 and msg.page_messages(df).count() == 6


def test_smaller_schemas_give_the_same_ids_and_counts(spark):
    body = feed(entry("S1", machines=[machine(), machine()], manuals=[manual()], addresses=2), entry("S2"),
                entry("S3", manuals=[manual()]).replace("<li>", "<li/><li></li><li>text</li><li>", 1))
    df = pages(spark, body, "<feed><entry>cut")
    isie = fd.first_by_class(F.col("entry.title.div.span"), "id")
    ids = lambda ents: sorted(ents.select("url", "entry_pos", isie.alias("isie")).collect())
    assert ids(P.key_entries(df, schema=fd.TITLE_ENTRY)) == ids(P.entries(df)) and len(ids(P.entries(df))) == 3
    want = sorted(P.treatment_counts(P.entries(df)).collect())
    assert sorted(P.treatment_counts(P.key_entries(df, schema=fd.LIST_ENTRY)).collect()) == want
    assert [r["n_manual"] for r in want] == [1, 0, 4]


def test_spans_left_out_of_the_parse_change_nothing(spark):
    """Keys and addresses with the spans that nobody looks up left out, against
    those of the whole pages: odd spans, broken spans, spans in comments, CDATA
    and other spans, runs longer than one match, markup behind the root."""
    step, by_hand = machine(), manual()
    put = lambda x: step.replace('<span class="datePublication">', x + '<span class="datePublication">')
    late = '<span class="datePublication">2031-03-05T07:11:41Z</span>'
    odd = [put(x) for x in (
        '<span class="a">x</span>' * 150, '<span class="a" class="b">x</span>', '<span class="a" t="1" t="2">x</span>',
        '<span class="a">&nope;</span>', '<span class="a">&amp;&lt;</span>', '<span class="a">a & b</span>',
        '<span class="a">]]></span>', '<span class="a">\x01</span>', '<span class="a">￿</span>', '<span class="a" t="<">x</span>',
        '<span class=" datePublication ">x</span>', "<span class='datePublication'>y</span>", '<span class="a" Class="datePublication">z</span>',
        '<span CLASS="datePublication">z</span>', '<span class="a"><b>x</b></span>', '<span class="a">x', '<span class="a"/>', '<x:span class="a">x</x:span>',
        '<!--<span class="a">x</span>-->', '<!-- -<span class="a">x</span>- -->', '<span class="date&#80;ublication">w</span>',
        '<span class="a">é 𝄞 line\n\ttab</span>\n <span class="b">\r</span>')]
    for inner in ('ab<span class="a">c</span>de', '<span class="a">c</span>de', '<span class="a">c</span>', '<b/>\n<span class="a">c</span> de',
                  '<i></i><span class="a">c</span><span class="b">d</span>', '<![CDATA[<span class="a">c</span>]]>', '<b>1</b><span class="a">c</span>x<b>2</b>y',
                  '<li><span class="a">c</span><b/></li>'):
        odd.append(step.replace(late, f'<span class="datePublication">{inner}</span>'))
    odd += ['<li><span class="a">x</span></li>', '<li><span class="a">x</span><span class="b">y</span></li><li/>', "<li></li>"]
    bodies = [feed(entry("ODD", machines=[o, step], manuals=[by_hand], addresses=2)) for o in odd]
    whole = feed(entry("W", machines=[step], addresses=1))
    bodies += [whole + x for x in ('<span class="a">x</span>', '\n<span class="a">x</span>\n', '<span class="a">x</span><b/>')]
    bodies += [whole.replace("</ul>", '</ul><span class="a">x</span>text'), whole.replace("</a:id>", '</a:id><span class="a">x</span>'),
               whole.replace('<span class="etat">', '<span class="etat>'), whole[:-30], None]
    df = pages(spark, *bodies)
    cols = ["url", "entry_pos", "kind", "li_pos", "key"]
    keys = lambda spans: sorted(map(str, P.with_keys(P.step_keys(P.key_entries(df, spans=spans))).select(*cols).collect()))
    assert keys(P.KEY_SPANS) == keys(None) and len(keys(None)) > 60
    homes = lambda spans: sorted(map(str, P.addresses(P.key_entries(df, spans=spans)).collect()))
    assert homes(P.ADDRESS_SPANS) == homes(None) and len(homes(None)) > 40
    state = lambda spans: sorted(map(str, fd.parse_feed(df, fd.KEY_ENTRY, spans=spans).select(
        "url", "parse_ok", "total_results", F.size("entries").alias("n")).collect()))
    assert state(P.KEY_SPANS) == state(None)
    # what is left to build does not grow with the spans that nobody looks up
    lean = df.filter("url = 'u0'").select(fd.without_spans(F.col("body"), P.KEY_SPANS).alias("b")).first()["b"]
    assert lean.count("<span") < 12 and bodies[0].count("<span") > 180
