"""Flatten feed entries into parcels: one row per processing step.

An entry is a mail item; each ``li`` under ``ul.traitement`` (machine step)
or ``ul.traitementManuel`` (manual step) yields one parcel that repeats the
entry's fields. Entries without steps yield nothing. Everything is
``posexplode`` over the parsed arrays: narrow, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.functions.text import blank_to_null, java_concat
from mailstream.operators import plain_feed
from mailstream.operators.feed import (
    ENTRY, KEY_ENTRY, LI, classes, client_spans, dd_for, explode_entries, first_by_class, parse_feed, pick, ul_items,
)

MACHINE, MANUAL = "machine", "manuel"

# Field names and their order, as the outbound JSON lists them.
PARCEL_FIELDS = ["isie", "image", "format", "priorite", "etat", "plateformTri",
                 "envoloppeExpire", "cleExterne", "updated", "published",
                 "derivationAdresse"]
MACHINE_FIELDS = ["debutTraitement", "idPlateforme", "idMachineTri", "entreeMachine",
                  "programmeTriTitle", "programmeTriId", "programmeTri",
                  "triSanctionPartiel", "etat", "receptacle", "receptacleType",
                  "receptacleNiveau", "receptacleLang", "receptacleReel",
                  "raisonModificationReceptacle", "receptacleReelNiveau",
                  "receptacleReelTitle", "receptacleReelLang", "plateformeSuivante",
                  "valeurAdressePrioritaire", "cedex", "typeAdressePrioritaire",
                  "service", "datePublication"]
MANUAL_FIELDS = ["date", "type", "etat", "idCentreVideocodage", "duree", "nomOperateur",
                 "datePublication", "status", "raisonFin", "sequenceFrappe"]
# Classes of the spans that ``step_keys`` and ``addresses`` look up.
KEY_SPANS = ("id", "datePublication")
ADDRESS_SPANS = ("id", "type", "code", "codeAcheDistri", "idRao", "typeRao", "idRaoLivraison", "typeRaoLivraison")
# Fields where an empty value means "absent" (null, omitted from JSON).
BLANK_IS_NULL = {"updated", "published", "debutTraitement", "date", "datePublication"}


def entries(pages: DataFrame, keep: tuple[str, ...] = ("url",), body_col: str = "body",
            schema: T.StructType = ENTRY, spans: tuple[str, ...] | None = None, texts: bool = False) -> DataFrame:
    """One row per feed entry with its 1-based position in the page. Pages
    that are not well-formed yield no entries (a page is all or nothing). With
    ``texts`` entries of pages in the plain form are texts (see ``parse_feed``):
    ``steps`` and the parcels made of them take both, other operators only structs."""
    return explode_entries(parse_feed(pages, schema, body_col, spans, texts), keep)


def key_entries(pages: DataFrame, keep: tuple[str, ...] = ("url",), body_col: str = "body",
                schema: T.StructType = KEY_ENTRY, spans: tuple[str, ...] | None = None) -> DataFrame:
    """``entries`` parsed with the pruned ``KEY_ENTRY``: enough for
    keys, step counts and addresses (``LIST_ENTRY``: for ids and step counts,
    ``TITLE_ENTRY``: for ids). ``spans``: the classes that are looked up
    (``KEY_SPANS``, ``ADDRESS_SPANS``), others need not be built."""
    return entries(pages, keep, body_col, schema=schema, spans=spans)


def entry_lookups(entry: Column) -> dict[str, Column]:
    """Per-entry helper arrays: title spans/divs, the client spans of the
    title, and their class names."""
    title = entry["title"]["div"]
    client = client_spans(title)
    return {"_ts": title["span"], "_tsc": classes(title["span"]),
            "_td": title["div"], "_tdc": classes(title["div"]),
            "_tcl": client, "_tclc": classes(client)}


def li_lookups(li: Column) -> dict[str, Column]:
    """Per-step helper arrays: spans, client spans and their class names
    (plus lower-cased classes for the case-insensitive ``cedex``)."""
    client = client_spans(li)
    return {"_ls": li["span"], "_lsc": classes(li["span"]), "_lslc": classes(li["span"], True),
            "_lcl": client, "_lclc": classes(client)}


def parcel_columns(entry: Column, lk: dict[str, Column] | None = None) -> dict[str, Column]:
    """Parent fields. ``lk`` maps helper names to columns (defaults to
    computing them inline)."""
    lk = lk or entry_lookups(entry)
    ts, tsc = lk["_ts"], lk["_tsc"]
    links = entry["link"]
    return {
        "isie": pick(ts, tsc, "id"),
        "image": F.coalesce(F.exists(links, lambda l: l["_href"].like("%format=jpeg%")),
                            F.lit(False)),
        "format": pick(ts, tsc, "format"),
        "priorite": pick(ts, tsc, "priorite"),
        "etat": pick(ts, tsc, "etat"),
        "plateformTri": entry["author"]["name"],
        "envoloppeExpire": pick(lk["_td"], lk["_tdc"], "expires"),
        "cleExterne": pick(lk["_tcl"], lk["_tclc"], "cleExterne"),
        "updated": blank_to_null(entry["updated"]),
        "published": blank_to_null(entry["published"]),
        "derivationAdresse": first_by_class(entry["content"]["div"]["span"], "derivation"),
    }


def machine_columns(li: Column, lk: dict[str, Column] | None = None) -> dict[str, Column]:
    lk = lk or li_lookups(li)
    sp, sc, cl, clc = lk["_ls"], lk["_lsc"], lk["_lcl"], lk["_lclc"]
    abbr = li["abbr"]
    return {
        "debutTraitement": blank_to_null(pick(sp, sc, "dateDebut")),
        "idPlateforme": pick(sp, sc, "idPlateforme"),
        "idMachineTri": pick(sp, sc, "idMachineTri"),
        "entreeMachine": pick(sp, sc, "entreeMachine"),
        "programmeTriTitle": first_by_class(abbr, "programmeTri", "_title"),
        "programmeTriId": first_by_class(abbr, "programmeTri", "_id"),
        "programmeTri": first_by_class(abbr, "programmeTri"),
        "triSanctionPartiel": dd_for(li, "parametresTri", "triSanctionPartiel"),
        "etat": pick(sp, sc, "etat"),
        "receptacle": pick(sp, sc, "receptacle"),
        "receptacleType": pick(sp, sc, "receptacle", "_type"),
        "receptacleNiveau": pick(sp, sc, "receptacle", "_niveau"),
        "receptacleLang": pick(sp, sc, "receptacle", "_lang"),
        "receptacleReel": pick(cl, clc, "receptacleReel"),
        "raisonModificationReceptacle": pick(cl, clc, "raisonModificationReceptacle"),
        "receptacleReelNiveau": pick(cl, clc, "receptacleReel", "_niveau"),
        "receptacleReelTitle": pick(cl, clc, "receptacleReel", "_title"),
        "receptacleReelLang": pick(cl, clc, "receptacleReel", "_lang"),
        "plateformeSuivante": pick(sp, sc, "plateformeSuivante"),
        "valeurAdressePrioritaire": pick(sp, sc, "valeur_adresse_prioritaire"),
        "cedex": pick(sp, lk["_lslc"], "cedex"),
        "typeAdressePrioritaire": pick(sp, sc, "type_adresse_prioritaire"),
        "service": pick(sp, sc, "service"),
        "datePublication": blank_to_null(pick(sp, sc, "datePublication")),
    }


def manual_columns(li: Column, lk: dict[str, Column] | None = None) -> dict[str, Column]:
    lk = lk or li_lookups(li)
    sp, sc, cl, clc = lk["_ls"], lk["_lsc"], lk["_lcl"], lk["_lclc"]
    return {
        "date": blank_to_null(pick(sp, sc, "date")),
        "type": pick(sp, sc, "type"),
        "etat": pick(sp, sc, "etat"),
        "idCentreVideocodage": pick(cl, clc, "idCentreVideocodage"),
        "duree": pick(cl, clc, "duree"),
        "nomOperateur": pick(cl, clc, "nomOperateur"),
        "datePublication": blank_to_null(pick(cl, clc, "datePublication")),
        "status": pick(sp, sc, "etat", "_title"),
        "raisonFin": pick(cl, clc, "raisonFin"),
        "sequenceFrappe": pick(cl, clc, "sequenceFrappe"),
    }


def address_columns(li: Column) -> dict[str, Column]:
    sp, cl = li["span"], client_spans(li)
    return {
        "originAdresse": first_by_class(sp, "type"),
        "CodeAdresse": first_by_class(sp, "code"),
        "codeAcheDistri": first_by_class(cl, "codeAcheDistri"),
        "idRao": first_by_class(sp, "idRao"),
        "typeRao": first_by_class(sp, "typeRao"),
        "idRaoLivraison": first_by_class(sp, "idRaoLivraison"),
        "typeRaoLivraison": first_by_class(sp, "typeRaoLivraison"),
    }


def _struct(cols: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in cols.items()])


# What is looked up in an entry's or a step's text: arrays of leaves, found and
# cleared in one projection each. ``own`` and ``client`` are the texts outside
# blocks and inside client blocks.
PARENT_OWN = ("id", "format", "priorite", "etat")
PARENT_ATOMS = ("name", "updated", "published")
MACHINE_OWN = ("dateDebut", "idPlateforme", "idMachineTri", "entreeMachine", "etat", "receptacle", "plateformeSuivante",
               "valeur_adresse_prioritaire", "(?i:cedex)", "type_adresse_prioritaire", "service", "datePublication")
MACHINE_CLIENT = ("receptacleReel", "raisonModificationReceptacle")
MANUAL_OWN = ("date", "type", "etat")
MANUAL_CLIENT = ("idCentreVideocodage", "duree", "nomOperateur", "datePublication", "raisonFin", "sequenceFrappe")
MACHINE_LEAVES = (*MACHINE_OWN, *MACHINE_CLIENT, "programmeTri")
MANUAL_LEAVES = (*MANUAL_OWN, *MANUAL_CLIENT)


def _found(own: Column, client: Column, ours: tuple[str, ...], theirs: tuple[str, ...], *more: Column) -> Column:
    leaves = F.array(*[plain_feed.leaf(own, n) for n in ours], *[plain_feed.leaf(client, n) for n in theirs], *more)
    return F.transform(leaves, lambda x: x)       # evaluated as it is: compiled, it would be too long


def plain_parent_columns(pl: Column, pa: Column, image: Column) -> dict[str, Column]:
    """Parent fields from the values of ``PARENT_OWN``, cleExterne, expires and
    derivation, and from ``PARENT_ATOMS``."""
    isie, form, priority, state, key, expires, derivation = (F.get(pl, F.lit(i)) for i in range(7))
    name, updated, published = (F.get(pa, F.lit(i)) for i in range(3))
    return {"isie": isie, "image": image, "format": form, "priorite": priority, "etat": state, "plateformTri": name,
            "envoloppeExpire": expires, "cleExterne": key, "updated": blank_to_null(updated),
            "published": blank_to_null(published), "derivationAdresse": derivation}


def plain_machine_columns(leaves: Column, values: Column, term: Column) -> dict[str, Column]:
    value = lambda n: F.get(values, F.lit(MACHINE_LEAVES.index(n)))
    attr = lambda n, a: plain_feed.attr(F.get(leaves, F.lit(MACHINE_LEAVES.index(n))), a)
    return {
        "debutTraitement": value("dateDebut"), "idPlateforme": value("idPlateforme"), "idMachineTri": value("idMachineTri"),
        "entreeMachine": value("entreeMachine"), "programmeTriTitle": attr("programmeTri", "title"),
        "programmeTriId": attr("programmeTri", "id"), "programmeTri": value("programmeTri"),
        "triSanctionPartiel": term, "etat": value("etat"), "receptacle": value("receptacle"),
        "receptacleType": attr("receptacle", "type"), "receptacleNiveau": attr("receptacle", "niveau"),
        "receptacleLang": attr("receptacle", "lang"), "receptacleReel": value("receptacleReel"),
        "raisonModificationReceptacle": value("raisonModificationReceptacle"),
        "receptacleReelNiveau": attr("receptacleReel", "niveau"), "receptacleReelTitle": attr("receptacleReel", "title"),
        "receptacleReelLang": attr("receptacleReel", "lang"), "plateformeSuivante": value("plateformeSuivante"),
        "valeurAdressePrioritaire": value("valeur_adresse_prioritaire"), "cedex": value("(?i:cedex)"),
        "typeAdressePrioritaire": value("type_adresse_prioritaire"), "service": value("service"),
        "datePublication": value("datePublication")}


def plain_manual_columns(leaves: Column, values: Column) -> dict[str, Column]:
    value = lambda n: F.get(values, F.lit(MANUAL_LEAVES.index(n)))
    return {
        "date": value("date"), "type": value("type"), "etat": value("etat"), "idCentreVideocodage": value("idCentreVideocodage"),
        "duree": value("duree"), "nomOperateur": value("nomOperateur"), "datePublication": value("datePublication"),
        "status": plain_feed.attr(F.get(leaves, F.lit(MANUAL_LEAVES.index("etat"))), "title"), "raisonFin": value("raisonFin"),
        "sequenceFrappe": value("sequenceFrappe")}


def with_parent(df: DataFrame, text: Column | None, parsed: dict[str, Column]) -> DataFrame:
    """Add ``_parent``, the parent fields: ``parsed``, or read off ``text``."""
    if text is None:
        return df.withColumn("_parent", _struct(parsed))
    there = text.isNotNull()
    df = df.withColumn("_pt", F.when(there, plain_feed.parent_text(text)))
    df = df.withColumn("_ti", F.when(there, plain_feed.title(F.col("_pt"))))
    df = df.withColumns({"_ow": plain_feed.own(F.col("_ti")), "_cl": plain_feed.client(F.col("_ti"))})
    derivation = plain_feed.leaf(plain_feed.in_content(F.col("_pt")), "derivation")
    leaves = _found(F.col("_ow"), F.col("_cl"), PARENT_OWN, ("cleExterne",), plain_feed.leaf(F.col("_ti"), "expires", "div"), derivation)
    found = F.transform(F.array(*[plain_feed.last(F.col("_pt"), n) for n in PARENT_ATOMS]), lambda x: x)
    read = F.col("_pt").isNotNull()
    df = df.withColumns({"_pl": F.when(read, plain_feed.values(leaves)), "_pa": F.when(read, plain_feed.atoms(found)),
                         "_im": F.rlike(F.col("_pt"), F.lit('<a:link[^<>]* href="[^"]*format=jpeg'))})
    plain = _struct(plain_parent_columns(F.col("_pl"), F.col("_pa"), F.col("_im")))
    return (df.withColumn("_parent", F.when(read, plain).otherwise(_struct(parsed)))
            .drop("_pt", "_ti", "_ow", "_cl", "_pl", "_pa", "_im"))


def with_leaves(st: DataFrame) -> DataFrame:
    """Steps with ``_t`` (a step's text, null for the parser's) get ``_lv``, what
    is looked up in it, ``_va``, the values of that, and ``_pa``, its partial sort."""
    t, own, inside, machine = F.col("_t"), F.col("_own"), F.col("_in"), F.col("_k") == 0
    st = st.withColumns({"_own": F.when(t.isNotNull(), plain_feed.own(t)), "_in": F.when(t.isNotNull(), plain_feed.client(t))})
    leaves = F.when(machine, _found(own, inside, MACHINE_OWN, MACHINE_CLIENT, plain_feed.leaf(own, "programmeTri", "abbr"))).otherwise(
        _found(own, inside, MANUAL_OWN, MANUAL_CLIENT))
    st = st.withColumns({"_lv": F.when(t.isNotNull(), leaves),
                         "_pa": F.when(t.isNotNull() & machine, plain_feed.term(own, "parametresTri", "triSanctionPartiel"))})
    return st.withColumn("_va", plain_feed.values(F.col("_lv"))).drop("_own", "_in")


def _machine(st: DataFrame) -> dict[str, Column]:
    """Machine fields of ``steps``, read off the text or the struct."""
    parsed = machine_columns(F.col("li"), _lk(LI_LK))
    if "_lv" not in st.columns:
        return parsed
    read = plain_machine_columns(F.col("_lv"), F.col("_va"), F.col("_pa"))
    return {n: F.when(F.col("_t").isNotNull(), read[n]).otherwise(c) for n, c in parsed.items()}


def _manual(st: DataFrame) -> dict[str, Column]:
    parsed = manual_columns(F.col("li"), _lk(LI_LK))
    if "_lv" not in st.columns:
        return parsed
    read = plain_manual_columns(F.col("_lv"), F.col("_va"))
    return {n: F.when(F.col("_t").isNotNull(), read[n]).otherwise(c) for n, c in parsed.items()}


def _lk(names) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


ENTRY_LK = ["_ts", "_tsc", "_td", "_tdc", "_tcl", "_tclc"]
LI_LK = ["_ls", "_lsc", "_lslc", "_lcl", "_lclc"]


STEP_ITEM = T.StructType([T.StructField("_k", T.IntegerType()),
                         T.StructField("li_pos", T.IntegerType()),
                         T.StructField("li", LI), T.StructField("_t", T.StringType())])
LISTS = ("traitement", "traitementManuel")


def step_array(entry: Column, kinds: tuple[int, ...] = (0, 1), text: Column | None = None) -> Column:
    """Machine steps then manual steps of an entry as one array of
    ``(_k, li_pos, li, _t)``; ``_k`` is 0 for machine, 1 for manual. A step of an
    entry with a ``text`` is its own text ``_t``, without ``li``."""
    empty, none = F.array().cast(T.ArrayType(LI)), F.lit(None)

    def tag(k: int, items: Column, li, t) -> Column:
        return F.transform(items, lambda x, i: F.struct(F.lit(k).alias("_k"), (i + 1).cast("int").alias("li_pos"),
                                                        li(x).cast(LI).alias("li"), t(x).cast("string").alias("_t")))

    def both(items, li, t) -> Column:
        return F.concat(*[tag(k, items(LISTS[k]), li, t) for k in kinds]).cast(T.ArrayType(STEP_ITEM))

    parsed = both(lambda cls: F.coalesce(ul_items(entry, cls), empty), lambda x: x, lambda x: none)
    return plain_feed.either(text, lambda e: both(lambda cls: plain_feed.items(e, cls), lambda x: none, lambda x: x), parsed)


def steps(ents: DataFrame, keep: tuple[str, ...] = ("url",), kinds: tuple[int, ...] = (0, 1)) -> DataFrame:
    """One row per step of ``kinds``: ``keep..., entry_pos, _parent, _k, li_pos,
    li`` and the step's helper arrays. The parent fields are made once per entry
    and only they are repeated, not the entry; a single explode serves both
    kinds. Entries without steps are dropped after an outer explode: an inner
    one would make the steps twice, to test their number."""
    parent = parcel_columns(F.col("entry"), _lk(ENTRY_LK))
    text = plain_feed.text_of(ents)
    ents = with_parent(ents.withColumns(entry_lookups(F.col("entry"))), text, parent)
    st = ents.select(*keep, "entry_pos", "_parent",
                     F.explode_outer(step_array(F.col("entry"), kinds, text)).alias("_s")).filter(F.col("_s").isNotNull())
    st = (st.select(*keep, "entry_pos", "_parent", "_s._k", "_s.li_pos", "_s.li", "_s._t")
          .withColumns(li_lookups(F.col("li"))))
    return st.drop("_t") if text is None else with_leaves(st)


def _kind(k: Column) -> Column:
    return F.when(k == 0, F.lit(MACHINE)).when(k == 1, F.lit(MANUAL))


def _flat(st: DataFrame, kind: str, cols: dict[str, Column], keep) -> DataFrame:
    return st.select(*keep, "entry_pos", F.lit(kind).alias("kind"), "li_pos", "_parent.*",
                     *[c.alias(n if n not in PARCEL_FIELDS else f"t_{n}") for n, c in cols.items()])


def machine_parcels(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per machine step, step fields beside the parent fields
    (``t_etat`` is the step's own state)."""
    st = steps(ents, keep, (0,))
    return _flat(st, MACHINE, _machine(st), keep)


def manual_parcels(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    st = steps(ents, keep, (1,))
    return _flat(st, MANUAL, _manual(st), keep)


def step_columns(st: DataFrame) -> DataFrame:
    """Rows with ``_k``, ``li`` and its lookup arrays get ``kind``,
    ``machine`` and ``manuel``."""
    mc, hc = _machine(st), _manual(st)
    return st.withColumns({
        "kind": _kind(F.col("_k")),
        "machine": F.when(F.col("_k") == 0, F.struct(*[c.alias(n) for n, c in mc.items()])),
        "manuel": F.when(F.col("_k") == 1, F.struct(*[c.alias(n) for n, c in hc.items()]))})


def step_id(k: Column, li: Column) -> Column:
    """Publication date of a step, where its kind has it."""
    client = client_spans(li)
    return blank_to_null(F.when(k == 0, pick(li["span"], classes(li["span"]), "datePublication"))
                         .otherwise(pick(client, classes(client), "datePublication")))


def parcels(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Machine steps then manual steps of every entry, one row each: parent
    fields, ``kind``, the step as ``machine`` or ``manuel`` struct (the other one
    null) and the record ``id`` (the step's publication date)."""
    st = step_columns(steps(ents, keep))
    # from the step itself: readers of the id alone do without the structs
    rid = F.when(F.col("_k") == 0, pick(F.col("_ls"), F.col("_lsc"), "datePublication")).otherwise(
        pick(F.col("_lcl"), F.col("_lclc"), "datePublication"))
    if "_lv" in st.columns:
        place = F.when(F.col("_k") == 0, MACHINE_LEAVES.index("datePublication")).otherwise(MANUAL_LEAVES.index("datePublication"))
        rid = F.when(F.col("_t").isNotNull(), F.get("_va", place)).otherwise(rid)
    return st.select(*keep, "entry_pos", "kind", "li_pos", "_parent.*", "machine", "manuel", blank_to_null(rid).alias("id"))


KEY_ITEM = T.StructType([T.StructField("_k", T.IntegerType()),
                        T.StructField("li_pos", T.IntegerType()),
                        T.StructField("id", T.StringType())])


def step_keys(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``keep..., entry_pos, kind, li_pos, isie, id`` per step: the fields
    of ``parcels`` that make its key, from entries parsed with either
    schema. Steps are in document order (machine list, then manual list)."""
    e = F.col("entry")
    ts = e["title"]["div"]["span"]
    empty = F.array().cast(T.ArrayType(KEY_ITEM))

    def ids(k: int, cls: str, spans) -> Column:
        items = ul_items(e, cls)
        return F.coalesce(F.transform(items, lambda li, i: F.struct(
            F.lit(k).alias("_k"), (i + 1).cast("int").alias("li_pos"),
            blank_to_null(pick(spans(li), classes(spans(li)), "datePublication")).alias("id"))),
            empty)

    steps_ = F.concat(ids(0, "traitement", lambda li: li["span"]),
                      ids(1, "traitementManuel", client_spans)).cast(T.ArrayType(KEY_ITEM))
    st = ents.select(*keep, "entry_pos", pick(ts, classes(ts), "id").alias("isie"),
                     F.explode(steps_).alias("_s"))
    return st.select(*keep, "entry_pos", _kind(F.col("_s._k")).alias("kind"),
                     F.col("_s.li_pos").alias("li_pos"), "isie", F.col("_s.id").alias("id"))


def treatment_counts(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Steps per entry (node counts); an absent list counts 0."""
    e = F.col("entry")
    return ents.select(*keep, "entry_pos",
                       first_by_class(e["title"]["div"]["span"], "id").alias("isie"),
                       F.coalesce(F.size(ul_items(e, "traitement")), F.lit(0)).cast("int").alias("n_machine"),
                       F.coalesce(F.size(ul_items(e, "traitementManuel")), F.lit(0)).cast("int").alias("n_manual"))


def addresses(ents: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per ``ul.adresses/li`` of each entry."""
    e = F.col("entry")
    st = ents.select(*keep, "entry_pos", first_by_class(e["title"]["div"]["span"], "id").alias("isie"),
                     F.posexplode(ul_items(e, "adresses")).alias("_p", "li"))
    cols = address_columns(F.col("li"))
    return st.select(*keep, "entry_pos", "isie", (F.col("_p") + 1).cast("int").alias("addr_pos"),
                     *[c.alias(n) for n, c in cols.items()])


def parcel_key(isie="isie", rid="id") -> Column:
    """``isie|id`` with Java string concatenation (null prints ``null``)."""
    return java_concat(F.col(isie) if isinstance(isie, str) else isie, F.lit("|"),
                       F.col(rid) if isinstance(rid, str) else rid)


def with_keys(p: DataFrame) -> DataFrame:
    return p.withColumn("key", parcel_key())


# Bits of a step's place in its list.
_STEP_BITS = 32


def packed_position(entry_pos: Column, is_manual: Column, li_pos: Column) -> Column:
    """A step's place in its page as one long: entry, then machine before
    manual, then the step's place in its list."""
    kind = F.when(is_manual, F.lit(1 << _STEP_BITS)).otherwise(0)
    return F.shiftleft(entry_pos.cast("long"), _STEP_BITS + 1) + kind + li_pos.cast("long")


def last_per_key(keyed: DataFrame, scope: tuple[str, ...] = ("url",)) -> DataFrame:
    """Last-value-wins per key within a page (a map filled in document
    order: entries in order, machine steps before manual ones, steps in
    order). The last place is a long, so a hash aggregate finds it, combined
    before the shuffle; other columns are fetched for the survivors only."""
    place = packed_position(F.col("entry_pos"), F.col("kind") == F.lit(MANUAL), F.col("li_pos"))
    last = keyed.groupBy(*scope, "key").agg(F.max(place).alias("_place"))
    step = F.col("_place").bitwiseAND(F.lit((1 << _STEP_BITS) - 1)).cast("int")
    kind = F.when(F.shiftright("_place", _STEP_BITS).bitwiseAND(F.lit(1)) == 1, F.lit(MANUAL)).otherwise(F.lit(MACHINE))
    last = last.select(*scope, "key", F.shiftright("_place", _STEP_BITS + 1).cast("int").alias("entry_pos"),
                       kind.alias("kind"), step.alias("li_pos"))
    if set(keyed.columns) <= set(last.columns):
        return last
    on = [*scope, "key", "entry_pos", "kind", "li_pos"]
    same = [keyed[c].eqNullSafe(last[c]) for c in on]
    from functools import reduce
    return keyed.join(last, reduce(lambda a, b: a & b, same), "left_semi").select(
        *scope, "key", *[c for c in keyed.columns if c not in (*scope, "key")])


def _json_struct(names: list[str], src: str) -> Column:
    fields = []
    for n in names:
        c = F.col(f"{src}.{n}")
        fields.append((c if n in BLANK_IS_NULL else F.coalesce(c, F.lit(""))).alias(n))
    return F.struct(*fields)


def parcel_json(p: DataFrame) -> Column:
    """The parcel as JSON: nulls omitted (so blank time fields vanish),
    other absent fields written as ``""``; the step's own fields in its
    kind's declared order."""
    parent = []
    for n in PARCEL_FIELDS:
        c = F.col(n)
        if n == "image":
            parent.append(c.alias(n))
        elif n in BLANK_IS_NULL:
            parent.append(c.alias(n))
        else:
            parent.append(F.coalesce(c, F.lit("")).alias(n))
    machine = F.struct(*parent, _json_struct(MACHINE_FIELDS, "machine").alias("traitement"))
    manual = F.struct(*parent, _json_struct(MANUAL_FIELDS, "manuel").alias("traitement"))
    return html_safe(F.when(F.col("kind") == F.lit(MACHINE), F.to_json(machine)).otherwise(F.to_json(manual)))


# Characters that the outbound JSON writes as escapes. None of
# them occurs in JSON's own signs, so the text can be rewritten as a whole.
HTML_ESCAPES = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", "=": "\\u003d", "'": "\\u0027",
                "\u2028": "\\u2028", "\u2029": "\\u2029"}


def html_safe(json: Column) -> Column:
    for sign, escape in HTML_ESCAPES.items():
        json = F.replace(json, F.lit(sign), F.lit(escape))
    return json
