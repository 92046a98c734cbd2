"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

# The base columns and the host verdict of op8. Rates, prior and limit follow
# ``host_rules``: a beta prior by moments of the weighted host rates.
_OP8_RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "long_words": "word_chars > 20 * n_words",
}


def _op8() -> str:
    flags = ", ".join(f"CAST(({c}) AS INT) AS x_{r}" for r, c in _OP8_RULES.items())
    fails = ", ".join(f"sum(x_{r}) AS f_{r}" for r in _OP8_RULES)
    means = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}" for r in _OP8_RULES)
    spread = ", ".join(f"sum(n * (f_{r} / n - m_{r}) ** 2) AS s_{r}" for r in _OP8_RULES)
    var = ", ".join(f"CASE WHEN k > 1 THEN (s_{r} - m_{r} * (1 - m_{r}) * (k - 1)) / (tn - nn / tn) ELSE 0 END AS v_{r}"
                    for r in _OP8_RULES)
    power = ", ".join(f"CASE WHEN v_{r} > 0 THEN least(1e6, greatest(10.0, m_{r} * (1 - m_{r}) / v_{r} - 1)) "
                      f"ELSE 1e6 END AS p_{r}" for r in _OP8_RULES)
    ok = " AND ".join(f"(f_{r} + m_{r} * p_{r}) / (n + p_{r}) < 0.5" for r in _OP8_RULES)
    return rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2
), rw AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id
), c AS (
  SELECT d.doc_id, source, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN rw ON d.doc_id IS NOT DISTINCT FROM rw.doc_id
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
), x AS (SELECT *, {flags} FROM b
), h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {fails} FROM x GROUP BY source
), m AS (SELECT sum(n) AS tn, sum(n * n) AS nn, count(*) AS k, {means} FROM h
), s AS (SELECT {spread} FROM h, m
), v AS (SELECT m.*, {var} FROM m, s
), p AS (SELECT *, {power} FROM v
), ok AS (SELECT source, {ok} AS host_ok FROM h, p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND host_ok AS kept, host_ok
FROM x JOIN ok ON x.source IS NOT DISTINCT FROM ok.source
"""


# CRC-32 (the reflected polynomial 0xEDB88320) of a string's UTF-8 bytes; the
# table of 256 values comes from the rule.
_CRC_TABLE = """tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
    FROM range(256) r(i)))"""


def _crc(x: str) -> str:
    byte = f"list_transform(range(0, strlen({x})), lambda i: CAST('0x' || substr(hex(encode({x})), 2 * i + 1, 2) AS BIGINT))"
    return (f"xor(list_reduce({byte}, lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT)), "
            f"4294967295)")


_OP11 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
f AS (SELECT rid, unnest(w) AS w FROM d),
e AS (SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
k AS (SELECT w, {_crc('w')} % 10000 AS b FROM (SELECT w FROM f UNION SELECT w FROM e), tab),
s AS (SELECT b, count(*) AS s FROM f JOIN k USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM e JOIN k USING (w) GROUP BY b),
g AS (SELECT s.b, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM f) + 10000)
        / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM e) + 10000)))) AS gain FROM s LEFT JOIN t ON s.b = t.b),
p AS (SELECT rid, count(*) AS n, floor(sum(gain) / count(*)) AS weight FROM f JOIN k USING (w) JOIN g USING (b) GROUP BY rid),
x AS (SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN p USING (rid)),
y AS (SELECT doc_id, n_features, weight,
        weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT *, CASE WHEN n_features >= 20
        THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM y)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) FROM y WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM z
"""

_OP13 = f"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
               ORDER BY turn NULLS FIRST, role, text) AS t
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, t, conv_id - conv_id % 100 AS base, {_crc('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM own, tab),
c AS (SELECT h.conv_id, list_concat(coalesce(b.t, [])[1:h.h], h.t[h.h + 1:]) AS t FROM h LEFT JOIN own b ON b.conv_id = h.base),
m AS (SELECT conv_id, t[1:d] AS p, d, d = len(t) AS last FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM c)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
      FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
a AS (SELECT n.p, n.d, n_convs, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON n.p = k.p),
u AS (SELECT p[1:e] AS p, sum(CAST(n_children = 0 AS INT)) AS n_leaves,
             sum((n_convs - 1) * CASE WHEN d > 0 THEN length(p[d].x) ELSE 0 END) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM a) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs,
       CAST(a.n_children AS BIGINT) AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN a ON n.p = a.p JOIN u ON n.p = u.p LEFT JOIN n o ON n.d > 0 AND o.p = n.p[1:n.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_host_rules": _op8(), "op11_importance": _OP11, "op13_prefix_trie": _OP13}
