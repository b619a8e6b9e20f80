"""Benchmark windows against plain loops."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from rasterloom.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    known = {}
    for item, text in items:
        w = words(text)
        for a in range(max(len(w) - 12, 1) if w else 0):
            known.setdefault(tuple(w[a : a + 13]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for a in range(len(w)):
            for n in range(1, 14):
                if a + n <= len(w) and tuple(w[a : a + n]) in known:
                    hit.update(range(a, a + n))
                    found |= known[tuple(w[a : a + n])]
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def cases():
    drawn = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "İx", "KelvinK", "ΑΒ"]
    items = [(i, " ".join(drawn.choices(vocabulary, k=drawn.choice([3, 12, 13, 20, 30])))) for i in range(12)]
    items += [(50, None), (51, "..."), (52, items[3][1].upper()), (3, items[3][1]), (53, "solo")]
    docs = [(i, " ".join(drawn.choices(vocabulary, k=60))) for i in range(20)]
    docs += [(100 + i, f"Before, {items[i][1]}! after; {items[(i + 1) % 12][1].replace(' ', ' - ')}") for i in range(12)]
    docs += [(200, None), (201, ""), (202, "!!"), (203, "solo " * 30_000), (100, docs[20][1]), (100, "solo"), (None, "solo")]
    return docs, items


def test_equal_loops(spark):
    docs, items = cases()
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "key", "w", "len", "at", "gram")})
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(2))
    got = d.contamination(left, right).drop("key").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    assert d.contamination(left.where("false"), right).collect() == []
    none = d.contamination(left, right.where("false")).collect()
    assert len(none) == len(docs) and not any(r.n_hit or r.n_items or r.contaminated for r in none)


def test_several_broadcasts(spark, monkeypatch):
    docs, items = cases()
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d, "BROADCAST_BYTES", 4000)
    assert sorted(map(tuple, d.contamination(left, right).drop("key").collect()), key=str) == brute(docs, items)


def test_dropping_and_cutting(spark):
    docs, items = cases()
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    bad = {r[0] for r in brute(docs, items) if r[5]}
    kept = d.drop_contaminated(left, right)
    assert kept.columns == left.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad
    cut = d.remove_spans(spark.createDataFrame([(1, "Oh, solo. And SOLO; so"), (2, "x"), (3, None)], "doc_id long, text string"), right)
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Oh, And so", 2: "x", 3: None}
