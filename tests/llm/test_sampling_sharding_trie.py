"""Importance resampling, k-d shards and the prefix trie against brute force,
with nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from mailstream.llm import importance, kd_shards, prefix_trie

DOCS = "doc_id long, text string, lang string, source string, n_chars long, Text string, rank string, shard string"
CONVS = "conv_id long, turn int, role string, text string, Role string, pos string"


def said(i):
    return " ".join(f"w{(i * 7 + k * k) % 53}" for k in range(i % 60))


def document_rows():
    texts = [None, "", "---", "Ab cd " * 30, "Ab cd " * 30, "É" * 40 + " ÀB ab1_c2", "x" * 50_000, "a b " * 20_000]
    texts += [said(i) for i in range(150)] + ["copied text of some words " * 8] * 90
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", "s10", None][i % 4], len(t or ""), "other", "r", "s")
            for i, t in enumerate(texts)]
    return rows + [rows[30], rows[30], (None, "null id " * 20, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(document_rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# -- importance resampling ----------------------------------------------------

def grams(text, max_n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)], len(words)


def drawn_by_hand(docs, target, max_n, buckets, percent, min_words):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for text in docs:
        s.update(map(bucket, grams(text[1], max_n)[0]))
    for text in target:
        t.update(map(bucket, grams(text, max_n)[0]))
    sn, tn = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sn + buckets) / ((s[b] + 1) * (tn + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text, *_ in docs:
        found, words = grams(text, max_n)
        weight = sum(gain[bucket(g)] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, words])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("max_n, buckets, percent", [(1, 10_000, 10), (3, 64, 40)])
def test_importance_equals_brute_force(spark, docs, max_n, buckets, percent):
    target = ["w1 w2 w3 Copied TEXT", None, "", "w1 w2 is new, w4"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.draw(docs, bench, percent, max_n, buckets, 20)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert got == drawn_by_hand(document_rows(), target, max_n, buckets, percent, 20)


def test_importance_empty_tables_and_real_documents(spark, docs, no_docs):
    bench = spark.createDataFrame([("w1 w2",)], "text string")
    assert importance.draw(no_docs, bench).collect() == []
    nothing = importance.draw(docs, bench.limit(0))
    assert nothing.count() == len(document_rows())
    kept = importance.resample(docs, bench, percent=30)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()


# -- k-d shards ---------------------------------------------------------------

def test_shards_are_whole_balanced_and_gapless(docs):
    rows = [r.asDict() for r in kd_shards.op12_shards(docs).collect()]
    given = sorted((str(d[0]), len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in document_rows())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == given
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))


def many(spark, n, hot):
    """Documents of 200 to 1,200 bytes; ``hot`` rows are copies of one text."""
    from pyspark.sql import functions as F
    text = F.when(F.col("id") < hot, F.lit("same words " * 60)).otherwise(
        F.repeat(F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(" ")), (F.col("id") % 150 + 40).cast("int")))
    return spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.element_at(F.array(*map(F.lit, "ab")), (
        F.col("id") % 2 + 1).cast("int")).alias("lang"), F.concat(F.lit("https://host"), (F.col("id") % 40).cast("string")).alias("source"),
        F.length(text).cast("long").alias("n_chars"))


@pytest.mark.parametrize("shards", [8, 5])
def test_shards_near_equal_with_a_hot_text(spark, shards):
    got = kd_shards.shard_documents(many(spark, 6000, 2000), shards).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == shards and size.max() < 1.02 * size.sum() / shards
    light = got[got["doc_id"] >= 2000]
    assert (light.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()


def test_copies_stay_together_and_target_bytes(spark):
    d = many(spark, 900, 0)
    got = kd_shards.shard_documents(d.union(d), target_bytes=400_000).toPandas()
    assert (got.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == -(-int(got["size"].sum()) // 400_000) and size.max() < 1.05 * 400_000


def test_first_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    rows = [(i, "x" * (i % 7 * 10), "en", "s", 5) for i in range(500)]     # only doc_id and the text's bytes differ
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = kd_shards.shard_documents(d, 2).toPandas().sort_values("doc_id")
    groups = {}                                        # equal texts lie at their smallest doc_id
    for r in got.itertuples():
        groups.setdefault((r.size, r.text_crc32), [r.doc_id, 0, set()])
        groups[r.size, r.text_crc32][1] += r.size
        groups[r.size, r.text_crc32][2].add(r.shard)
    points = sorted(groups.values())
    side = [min(p[2]) for p in points if len(p[2]) == 1]
    assert side == sorted(side)                        # below the median 0, above it 1
    assert abs(got[got["shard"] == 0]["size"].sum() - got["size"].sum() / 2) <= got["size"].sum() / kd_shards.PIECES


def test_shards_empty_and_written(spark, docs, no_docs, tmp_path):
    assert kd_shards.op12_shards(no_docs).collect() == []
    kd_shards.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert sorted(back.columns) == sorted([c if c != "Text" else "Text_2" for c in docs.columns] + ["kd_shard"])


# -- prefix trie --------------------------------------------------------------

def conversation_rows():
    rows = []
    for c in list(range(0, 60)) + list(range(100, 130)) + [205, 206, 230, 1_000_007]:
        length = 1 + (c * 5) % 9 if c % 10 else 2
        for t in range(length):
            rows.append((c, t, ["user", "assistant", None][t % 3], f"say {min(t, 3) + (c % 4 if t > 3 else 0)} é" if t else None, "x", "y"))
    rows += [(300, None, "user", "first", None, None), (300, 0, "user", "second", None, None)]
    rows += [(301, k, "user", f"long {k}", None, None) for k in range(40)]
    rows += [(302, k, "user", f"long {k}", None, None) for k in range(33)]
    rows += [(301, 39, "user", "long 39", None, None)] * 2
    return rows + [(None, 1, "user", "nobody's", None, None)]


def rebuilt_by_hand(rows):
    from pyspark.sql import Row  # noqa: F401
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def trie_by_hand(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = Counter(p[:-1] for p in members if p)
    rows = []
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        rows.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p], sum(not kids[q] for q in below),
                     sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                     hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()))
    return sorted(rows, key=str)


@pytest.mark.parametrize("seg, piece", [(256, 20_000), (256, 7), (3, 11), (1, 4), (8, 1)])
def test_trie_equals_brute_force(spark, seg, piece):
    convs = spark.createDataFrame(conversation_rows(), CONVS).repartition(4)
    sizes, turns = prefix_trie.rebuild(prefix_trie.numbered_turns(convs))
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(sizes, turns, seg, piece).collect()), key=str)
    assert got == trie_by_hand(rebuilt_by_hand(conversation_rows()))


def test_trie_of_nothing(spark):
    assert prefix_trie.op13_prefix_trie(spark.createDataFrame([], CONVS)).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b", None, None)], CONVS)
    assert prefix_trie.op13_prefix_trie(only_null).collect() == []


def test_findclose_matches_a_stack():
    import random

    import numpy as np

    from mailstream.llm.parens import Parens
    rnd, bits, depth = random.Random(3), [], 0
    while len(bits) < 3000 or depth:
        up = depth == 0 or (len(bits) < 3000 and rnd.random() < 0.55)
        bits.append(int(up))
        depth += 1 if up else -1
    p, stack, match = Parens(np.array(bits, dtype=np.uint8)), [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            match[stack.pop()] = i
    assert {i: p.findclose(i) for i in match} == match
    assert p.closes().tolist() == [match[i] for i in p.opens.tolist()]
    end, leaves, parent = p.subtrees()
    assert all(parent[k] < k and (parent[k] < 0 or end[parent[k]] >= end[k]) for k in range(len(end)))
