"""DuckDB SQL for each registered query, over the driver's tables.

The Atom queries use a shared prelude that derives, with plain joins and
window functions, what parsing the rendered pages must give back.
"""

from __future__ import annotations

from mailstream.operators.paging import DEFAULT_BASE_URL as BASE

ISO_S = "'%Y-%m-%dT%H:%M:%SZ'"
ISO_M = "'%Y-%m-%dT%H:%M:00Z'"

SPLIT = ("CASE WHEN {x} <> '' AND rtrim({x}, ' ') = '' THEN []::VARCHAR[] "
         "ELSE string_split(rtrim({x}, ' '), ' ') END")


def _split(x: str) -> str:
    return SPLIT.format(x=x)


def _java_hash(x: str) -> str:
    u = (f"list_reduce(list_transform(string_split({x}, ''), lambda c: unicode(c)::BIGINT), "
         f"lambda a, c: (a * 31 + c) % 4294967296, 0::BIGINT)")
    return f"(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 ELSE {u} END)"


def _partition(x: str, n: int = 8) -> str:
    return f"CAST((({_java_hash(x)} % {n}) + {n}) % {n} AS INTEGER)"


WORDCOUNT = f"""
SELECT word, count(*) AS count
FROM (SELECT unnest({_split('text')}) AS word FROM documents)
GROUP BY word"""

WINDOW_TOTALS = f"""
WITH c AS (SELECT date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY 1),
b AS (SELECT min(m) AS lo, max(m) AS hi FROM c),
g AS (SELECT unnest(range(lo, hi + INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS m FROM b)
SELECT strftime(g.m, {ISO_M}) AS start, strftime(g.m + INTERVAL 1 MINUTE, {ISO_M}) AS "end",
       coalesce(c.n, 0)::BIGINT AS total
FROM g LEFT JOIN c USING (m)"""

POLL_WINDOWS = f"""
SELECT DISTINCT strftime(date_trunc('minute', ts), {ISO_S}) AS tick,
       strftime(date_trunc('minute', ts) - INTERVAL 6 MINUTE, {ISO_M}) AS start,
       strftime(date_trunc('minute', ts) - INTERVAL 5 MINUTE, {ISO_M}) AS "end"
FROM events"""

FLAG_PROBES = f"""
SELECT l_returnflag, l_linestatus, strftime(min(l_shipdate), {ISO_M}) AS start,
       strftime(max(l_shipdate), {ISO_M}) AS "end", count(*)::BIGINT AS total
FROM lineitem GROUP BY 1, 2"""


def _page_plan(inclusive: bool) -> str:
    stop = "total + 1" if inclusive else "total"
    return f"""
WITH p AS ({FLAG_PROBES})
SELECT l_returnflag, l_linestatus, start, "end", total, CAST(si AS BIGINT) AS start_index,
       1000 AS count
FROM (SELECT *, unnest(range(1, {stop}, 1000)) AS si FROM p)"""


def _url(start: str, end: str, si: str, cnt: str) -> str:
    return (f"('{BASE}' || 'dateDebut=' || {start} || '&dateFin=' || {end} || "
            f"'&startIndex=' || CAST({si} AS VARCHAR) || '&count=' || CAST({cnt} AS VARCHAR))")


ROUTE_WINDOWS = f"""
WITH wt AS ({WINDOW_TOTALS}),
pg AS (SELECT start, "end", unnest(range(1, total + 1, 1000)) AS si FROM wt WHERE total <> 0)
SELECT 'urls' AS topic, '' AS key, {_url('start', '"end"', 'si', '1000')} AS value,
       CAST(NULL AS VARCHAR) AS reason FROM pg
UNION ALL
SELECT 'catchingTopic', '', {_url('start', '"end"', '1', '1')}, 'empty' FROM wt WHERE total = 0"""

# Probed windows: the minutes' totals, but for the probes that fail by the
# minute's number.
PROBED = f"""
WITH wt AS ({WINDOW_TOTALS}),
n AS (SELECT *, CAST(epoch(strptime(start, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT) // 60 AS k FROM wt),
f AS (SELECT *, CASE WHEN k % 17 = 7 THEN 'http_404' WHEN k % 11 = 3 THEN 'http_503'
                     WHEN k % 13 = 5 THEN 'parse_error' WHEN k % 19 = 11 THEN 'no_total' END AS cause FROM n),
pg AS (SELECT start, "end", unnest(range(1, total + 1, 1000)) AS si FROM f WHERE cause IS NULL AND total > 0)
SELECT 'urls' AS topic, '' AS key, {_url('start', '"end"', 'si', '1000')} AS value,
       CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS cause FROM pg
UNION ALL
SELECT 'catchingTopic', '', {_url('start', '"end"', '1', '1')}, CASE WHEN cause IS NULL THEN 'empty' ELSE 'failed' END, cause
FROM f WHERE cause IS NOT NULL OR total = 0"""

LATE_LANE = f"""
WITH a AS (SELECT event_id, ts, ts + to_hours(CAST(event_id % 11 AS INTEGER)) AS came FROM events),
s AS (SELECT min(came) AS lo, max(came) AS hi FROM a),
b AS (SELECT event_id, ts, least(CAST(floor(date_sub('second', lo, came) * 12 / greatest(date_sub('second', lo, hi), 1)) AS INT), 11)
             AS batch FROM a, s),
w AS (SELECT batch, max(ts) AS latest FROM b GROUP BY batch),
p AS (SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM w),
l AS (SELECT event_id, date_trunc('minute', ts) AS m,
             coalesce(date_trunc('minute', ts) + INTERVAL 1 MINUTE <= before - INTERVAL 5 MINUTE, false) AS late
      FROM b JOIN p USING (batch))
SELECT 'total' AS lane, strftime(m, {ISO_M}) AS start, CAST(NULL AS BIGINT) AS event_id, count(*) AS total
FROM l WHERE NOT late GROUP BY m
UNION ALL SELECT 'late', strftime(m, {ISO_M}), event_id, 1 FROM l WHERE late"""

# -- Atom round trip prelude -------------------------------------------------

PCT = "CAST(CAST(round({c} * 100) AS INTEGER) AS VARCHAR)"
FLOOR = "CAST(CAST(floor({c}) AS BIGINT) AS VARCHAR)"

ROUND_TRIP = f"""
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         c_custkey, c_name, c_nationkey, c_mktsegment, n_name, n_regionkey,
         printf('%08X', o_orderkey) AS isie, o_orderkey // 1000 AS page
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey),
pg AS (SELECT page, min(o_orderdate) AS lo, max(o_orderdate) AS hi, count(*) AS n_entries
       FROM o GROUP BY page),
pu AS (SELECT page, n_entries,
       {_url(f"strftime(lo, {ISO_M})", f"strftime(hi, {ISO_M})", 'page * 1000 + 1', '1000')} AS url
       FROM pg),
ent AS (
  SELECT o.*, pu.url,
         CAST(row_number() OVER (PARTITION BY o.page ORDER BY o_orderkey) AS INTEGER) AS entry_pos,
         (o_orderstatus = 'F') AS image, o_orderstatus AS format, o_orderpriority AS priorite,
         'E' || o_orderstatus AS etat, n_name AS plateformTri,
         CASE WHEN o_totalprice >= 250000 THEN 'oui' ELSE 'non' END AS envoloppeExpire,
         'C' || CAST(o_custkey AS VARCHAR) AS cleExterne,
         strftime(o_orderdate, {ISO_S}) AS updated,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE strftime(o_orderdate + INTERVAL 1 DAY, {ISO_S}) END AS published,
         c_mktsegment AS derivationAdresse
  FROM o JOIN pu USING (page)),
st AS (
  SELECT l.*, (l_linenumber % 2 = 0) AS machine,
         CASE WHEN l_linenumber % 2 = 0 THEN 'machine' ELSE 'manuel' END AS kind,
         CAST(row_number() OVER (PARTITION BY l_orderkey, (l_linenumber % 2 = 0)
              ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS li_pos,
         strftime(l_shipdate, {ISO_S}) AS datePublication
  FROM lineitem l),
mp AS (
  SELECT ent.url, ent.entry_pos, st.kind, st.li_pos, ent.isie, ent.image, ent.format, ent.priorite,
         ent.etat, ent.plateformTri, ent.envoloppeExpire, ent.cleExterne, ent.updated,
         ent.published, ent.derivationAdresse,
         CASE WHEN l_linestatus = 'O' THEN NULL
              ELSE strftime(l_shipdate - INTERVAL 1 DAY, {ISO_S}) END AS debutTraitement,
         'S' || CAST(l_suppkey AS VARCHAR) AS idPlateforme,
         CAST(l_partkey AS VARCHAR) AS idMachineTri,
         CAST(l_linenumber AS VARCHAR) || '-1' AS entreeMachine,
         CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS programmeTriTitle,
         CAST(l_linenumber AS VARCHAR) AS programmeTriId,
         l_returnflag AS programmeTri,
         {PCT.format(c='l_discount')} AS triSanctionPartiel,
         l_linestatus AS t_etat,
         l_returnflag || CAST(l_linenumber AS VARCHAR) AS receptacle,
         'FINAL' AS receptacleType,
         CAST(l_linenumber AS VARCHAR) AS receptacleNiveau,
         CASE WHEN l_returnflag = 'N' THEN 'fr' END AS receptacleLang,
         'R' || CAST(l_suppkey AS VARCHAR) AS receptacleReel,
         CASE WHEN l_returnflag = 'R' THEN 'SATURE' END AS raisonModificationReceptacle,
         {PCT.format(c='l_tax')} AS receptacleReelNiveau,
         l_linestatus AS receptacleReelTitle,
         CASE WHEN l_returnflag = 'A' THEN 'fr' END AS receptacleReelLang,
         'P' || CAST(l_partkey AS VARCHAR) AS plateformeSuivante,
         {FLOOR.format(c='l_extendedprice')} AS valeurAdressePrioritaire,
         CASE WHEN l_tax >= 0.04 THEN 'oui' ELSE 'non' END AS cedex,
         CASE WHEN l_linestatus = 'F' THEN 'zone' ELSE 'round' END AS typeAdressePrioritaire,
         'NO <SERVICE> = R&D' AS service,
         st.datePublication
  FROM ent JOIN st ON o_orderkey = l_orderkey WHERE st.machine),
hp AS (
  SELECT ent.url, ent.entry_pos, st.kind, st.li_pos, ent.isie, ent.image, ent.format, ent.priorite,
         ent.etat, ent.plateformTri, ent.envoloppeExpire, ent.cleExterne, ent.updated,
         ent.published, ent.derivationAdresse,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE strftime(l_shipdate, {ISO_S}) END AS date,
         l_returnflag AS type, l_linestatus AS t_etat,
         'V' || CAST(l_suppkey AS VARCHAR) AS idCentreVideocodage,
         {FLOOR.format(c='l_quantity')} AS duree,
         'op' || CAST(l_partkey AS VARCHAR) AS nomOperateur,
         st.datePublication,
         'S' || CAST(l_linenumber AS VARCHAR) AS status,
         l_returnflag AS raisonFin,
         CAST(l_linenumber AS VARCHAR) AS sequenceFrappe
  FROM ent JOIN st ON o_orderkey = l_orderkey WHERE NOT st.machine),
allp AS (
  SELECT url, entry_pos, kind, li_pos, isie, image, format, priorite, etat, plateformTri,
         envoloppeExpire, cleExterne, updated, published, derivationAdresse,
         datePublication AS id, debutTraitement, NULL::VARCHAR AS date,
         isie || '|' || coalesce(datePublication, 'null') AS key
  FROM mp
  UNION ALL
  SELECT url, entry_pos, kind, li_pos, isie, image, format, priorite, etat, plateformTri,
         envoloppeExpire, cleExterne, updated, published, derivationAdresse,
         datePublication, NULL::VARCHAR, date,
         isie || '|' || coalesce(datePublication, 'null')
  FROM hp),
lastp AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY url, key
             ORDER BY entry_pos DESC, CASE WHEN kind = 'machine' THEN 0 ELSE 1 END DESC,
                      li_pos DESC) AS rn
    FROM allp) WHERE rn = 1)"""


def _q(s: str) -> str:
    return "'\"' || coalesce(" + s + ", '') || '\"'"


def _opt(name: str, s: str) -> str:
    return f"coalesce(',\"{name}\":\"' || {s} || '\"', '')"


PARENT_JSON = ("'{\"isie\":' || " + _q("isie") +
               " || ',\"image\":' || CASE WHEN image THEN 'true' ELSE 'false' END" +
               "".join(f" || ',\"{n}\":' || {_q(n)}" for n in
                       ["format", "priorite", "etat", "plateformTri", "envoloppeExpire",
                        "cleExterne"]) +
               " || " + _opt("updated", "updated") + " || " + _opt("published", "published") +
               " || ',\"derivationAdresse\":' || " + _q("derivationAdresse"))

MACHINE_ORDER = ["debutTraitement", "idPlateforme", "idMachineTri", "entreeMachine",
                 "programmeTriTitle", "programmeTriId", "programmeTri", "triSanctionPartiel",
                 "etat", "receptacle", "receptacleType", "receptacleNiveau", "receptacleLang",
                 "receptacleReel", "raisonModificationReceptacle", "receptacleReelNiveau",
                 "receptacleReelTitle", "receptacleReelLang", "plateformeSuivante",
                 "valeurAdressePrioritaire", "cedex", "typeAdressePrioritaire", "service",
                 "datePublication"]
MANUAL_ORDER = ["date", "type", "etat", "idCentreVideocodage", "duree", "nomOperateur",
                "datePublication", "status", "raisonFin", "sequenceFrappe"]
NULLABLE = {"debutTraitement", "date", "datePublication"}


def _step_json(order: list[str]) -> str:
    """Every field fragment starts with a comma; the first comma is cut."""
    parts = []
    for n in order:
        src = "t_etat" if n == "etat" else n
        if n in NULLABLE:
            parts.append(f"coalesce(',\"{n}\":\"' || {src} || '\"', '')")
        else:
            parts.append(f"',\"{n}\":' || {_q(src)}")
    return "'{' || substr(" + " || ".join(parts) + ", 2) || '}'"


def _html_safe(json: str) -> str:
    """The JSON library's escapes of < > & = and '."""
    for code in (60, 62, 38, 61, 39):
        json = f"replace({json}, chr({code}), '\\u00{code:02x}')"
    return json


JSON_SELECT = f"""
json AS (
  SELECT url, entry_pos, kind, li_pos, isie || '|' || coalesce(datePublication, 'null') AS key,
         {_html_safe(PARENT_JSON + " || ',\"traitement\":' || " + _step_json(MACHINE_ORDER) + " || '}'")} AS value
  FROM mp
  UNION ALL
  SELECT url, entry_pos, kind, li_pos, isie || '|' || coalesce(datePublication, 'null'),
         {_html_safe(PARENT_JSON + " || ',\"traitement\":' || " + _step_json(MANUAL_ORDER) + " || '}'")}
  FROM hp)"""

LAST_JSON = f"""
SELECT j.url, j.key, j.value FROM json j
JOIN lastp l ON j.url = l.url AND j.key = l.key AND j.entry_pos = l.entry_pos
             AND j.kind = l.kind AND j.li_pos = l.li_pos"""

DEAD_URLS = """
(SELECT url || '&retry=1' AS url, 'http_404' AS reason FROM pu
 UNION ALL SELECT url || '&retry=2', 'http_503' FROM pu
 UNION ALL SELECT url || '&retry=3', 'parse_error' FROM pu)"""

ROUTE_PAGES = f"""
WITH {ROUND_TRIP}, {JSON_SELECT}, lj AS ({LAST_JSON})
SELECT 'JsonTopic' AS topic, key, value, CAST(NULL AS VARCHAR) AS reason FROM lj
UNION ALL
SELECT 'catchingTopicUrls', url, url, reason FROM {DEAD_URLS}"""

EGRESS = f"""
WITH {ROUND_TRIP}, {JSON_SELECT}, lj AS ({LAST_JSON}),
m AS (SELECT 'JsonTopic' AS topic, key, value FROM lj
      UNION ALL
      SELECT 'catchingTopicUrls', url, url FROM {DEAD_URLS})
SELECT topic, key, value,
       {_partition("CASE WHEN key = '' THEN value ELSE key END")} AS partition
FROM m"""

MACHINE_COLS = ("url, entry_pos, kind, li_pos, isie, image, format, priorite, etat, plateformTri, "
                "envoloppeExpire, cleExterne, updated, published, derivationAdresse, "
                + ", ".join("t_etat" if n == "etat" else n for n in MACHINE_ORDER))
MANUAL_COLS = ("url, entry_pos, kind, li_pos, isie, image, format, priorite, etat, plateformTri, "
               "envoloppeExpire, cleExterne, updated, published, derivationAdresse, "
               + ", ".join("t_etat" if n == "etat" else n for n in MANUAL_ORDER))

ORACLES: dict[str, str] = {
    "wordcount": WORDCOUNT,
    "wordcount_top10": f"SELECT * FROM ({WORDCOUNT}) ORDER BY count DESC, word LIMIT 10",
    "wordcount_by_interval": f"""
SELECT strftime(time_bucket(INTERVAL 2 SECOND, ts), {ISO_S}) AS batch_start, word,
       count(*) AS count
FROM (SELECT ts, unnest({_split('event_type')}) AS word FROM events)
GROUP BY 1, 2""",
    "line_scan": """
WITH s AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
t AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS l FROM s)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, value
FROM (SELECT doc_id, unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS value FROM t)""",
    "topic_scan": """
SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, props AS value
FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
    "poll_windows": POLL_WINDOWS,
    "probe_urls": f"SELECT start, \"end\", {_url('start', '\"end\"', '1', '1')} AS url FROM ({POLL_WINDOWS})",
    "window_totals": WINDOW_TOTALS,
    "route_windows": ROUTE_WINDOWS,
    "page_plan": _page_plan(True),
    "page_plan_exclusive": _page_plan(False),
    "page_urls": f"""
SELECT l_returnflag, l_linestatus, start_index, {_url('start', '"end"', 'start_index', 'count')} AS url
FROM ({_page_plan(True)})""",
    "page_slices": """
SELECT o_orderkey, row_index, (row_index - 1) // 1000 AS page, ((row_index - 1) // 1000) * 1000 + 1 AS start_index
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_index FROM orders)""",
    "fetch_lookup": """
WITH req AS (SELECT url FROM pages UNION ALL SELECT url || '#missing' FROM pages)
SELECT req.url, CASE WHEN p.url IS NULL THEN 404 ELSE 200 END AS status, p.html AS body
FROM req LEFT JOIN pages p ON req.url = p.url""",
    "feed_total": f"WITH {ROUND_TRIP} SELECT url, CAST(n_entries AS INTEGER) AS total_results, "
                  f"CAST(n_entries AS INTEGER) AS n_entries FROM pu",
    "entry_positions": f"WITH {ROUND_TRIP} SELECT url, entry_pos, isie FROM ent",
    "machine_parcels": f"WITH {ROUND_TRIP} SELECT {MACHINE_COLS} FROM mp",
    "manual_parcels": f"WITH {ROUND_TRIP} SELECT {MANUAL_COLS} FROM hp",
    "parcels": f"""WITH {ROUND_TRIP}
SELECT url, entry_pos, kind, li_pos, isie, image, format, priorite, etat, plateformTri,
       envoloppeExpire, cleExterne, updated, published, derivationAdresse, id FROM allp""",
    "parcel_keys": f"WITH {ROUND_TRIP} SELECT url, entry_pos, kind, li_pos, key FROM allp",
    "parcels_last": f"WITH {ROUND_TRIP} SELECT url, key, entry_pos, kind, li_pos FROM lastp",
    "treatment_counts": f"""WITH {ROUND_TRIP}
SELECT url, entry_pos, isie,
       CAST(count(*) FILTER (WHERE l_linenumber % 2 = 0) AS INTEGER) AS n_machine,
       CAST(count(*) FILTER (WHERE l_linenumber % 2 = 1) AS INTEGER) AS n_manual
FROM ent LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY url, entry_pos, isie""",
    "addresses": f"""WITH {ROUND_TRIP}
SELECT url, entry_pos, isie, 1 AS addr_pos, 'SCAN' AS originAdresse, c_name AS CodeAdresse,
       n_name || '-' || CAST(c_nationkey AS VARCHAR) AS codeAcheDistri,
       CAST(c_custkey AS VARCHAR) AS idRao, c_mktsegment AS typeRao,
       CAST(n_regionkey AS VARCHAR) AS idRaoLivraison, 'stops' AS typeRaoLivraison
FROM ent WHERE c_custkey IS NOT NULL""",
    "blank_to_null": f"""WITH {ROUND_TRIP}
SELECT url, entry_pos, kind, li_pos, isie, updated, published, debutTraitement, date,
       id AS datePublication FROM allp""",
    "parcel_json": f"WITH {ROUND_TRIP}, {JSON_SELECT} SELECT url, entry_pos, kind, li_pos, key, value FROM json",
    "route_pages": ROUTE_PAGES,
    "egress_messages": EGRESS,
    "replay_dead_letters": f"""WITH {ROUND_TRIP}
SELECT 'urls' AS topic, '' AS key, url AS value, reason AS retry_reason FROM {DEAD_URLS}""",
    "map_explode": f"WITH {ROUND_TRIP}, {JSON_SELECT} {LAST_JSON}",
    "partition_assign": f"""
SELECT c_custkey, c_name AS key, CAST({_java_hash('c_name')} AS INTEGER) AS hash,
       {_partition('c_name')} AS partition
FROM customer""",
    "post_payload": """
SELECT event_id AS id,
       printf('{"id": "%d", "text": "%s", "pos": "%f", "neg": "%f", "score": "%s" }',
              event_id, event_type, CAST(value AS FLOAT), CAST(value AS FLOAT), props) AS payload
FROM events""",
    "late_rows": f"""
SELECT event_id, strftime(date_trunc('minute', ts), {ISO_M}) AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 6 MINUTE, {ISO_M}) AS polled_at,
       strftime(ts + to_minutes(CAST(event_id % 11 AS INTEGER)), {ISO_S}) AS published_at
FROM events
WHERE ts + to_minutes(CAST(event_id % 11 AS INTEGER)) > date_trunc('minute', ts) + INTERVAL 6 MINUTE""",
    "recovery_log": f"""
WITH wt AS ({WINDOW_TOTALS})
SELECT {_url('start', '"end"', '1', '1')} AS value FROM wt WHERE total = 0""",
    "stream_wordcount": f"""
SELECT word, count(*) AS count
FROM (SELECT unnest({_split("concat_ws(' ', event_type, props)")}) AS word FROM events)
GROUP BY word""",
    "stream_route": ROUTE_PAGES,
    "probe_route": PROBED,
    "stream_clock": f"""
SELECT strftime(m, {ISO_S}) AS tick, strftime(m - INTERVAL 6 MINUTE, {ISO_M}) AS start, strftime(m - INTERVAL 5 MINUTE, {ISO_M}) AS "end"
FROM (SELECT unnest(generate_series(date_trunc('minute', min(ts)), date_trunc('minute', max(ts)), INTERVAL 1 MINUTE)) AS m FROM events)""",
    "stream_post": """
SELECT event_id AS id, CAST(CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts, event_id % 7 <> 0 AS delivered
FROM events""",
    "stream_replay": f"""
WITH {ROUND_TRIP}, {JSON_SELECT}, lj AS ({LAST_JSON})
SELECT 'JsonTopic' AS topic, key, value, CAST(NULL AS VARCHAR) AS reason, 2 AS attempts FROM lj
UNION ALL
SELECT 'finalLane', url, url, reason, 3 FROM {DEAD_URLS} WHERE reason <> 'http_503'""",
    "stream_probe_route": f"""
WITH m AS ({PROBED})
SELECT * FROM m UNION ALL SELECT 'recovery', '', value, NULL, NULL FROM m WHERE topic = 'catchingTopic'""",
    "stream_late_lane": LATE_LANE,
    "null_key_lane": f"""
SELECT event_type AS topic, event_id AS seq, key, props AS value,
       CASE WHEN key IS NULL THEN CAST(event_id % 8 AS INTEGER) ELSE {_partition('key')} END AS partition
FROM (SELECT *, CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS key FROM events)""",
    "stream_window_totals": f"""
SELECT strftime(date_trunc('minute', ts), {ISO_M}) AS start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 MINUTE, {ISO_M}) AS "end",
       count(*) AS total
FROM events GROUP BY 1, 2""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
