"""Ranked search against plain loops."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import lexical


def plain(docs, items, top=50):
    def terms(text):
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            score = 0
            for t in set(terms(text)) & set(c):
                m = 50 + (50 * n * n_docs) // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def corpus(n, seed=3):
    drawn = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "ß", "日本"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(drawn.choices(words, weight, k=drawn.randint(1, 40)))) for i in range(n)]
    return docs + [(n, docs[0][1]), (n + 1, None), (n + 2, ""), (n + 3, " ,.-"), (None, docs[1][1]), (5, docs[5][1]), (n + 4, "w1 " * 60_000)]


ITEMS = [(1, "W1, w2 w3!"), (2, "w59 w58 É É日本"), (3, None), (4, "--"), (5, "unknown"), (None, "w7 w7"), (6, "w1"), (6, "w1"), (7, "Éa ß w30 w31 w0")]


@pytest.mark.parametrize(("shard", "bundle", "limit"), [(8192, 256, 1 << 25), (16, 2, 1 << 25), (50, 3, 128)])
def test_against_loops(spark, monkeypatch, shard, bundle, limit):
    monkeypatch.setattr(lexical, "VOCABULARY_BYTES", limit)
    docs = corpus(400)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("term", "shard", "id", "item", "score", "rank")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(1) for c in ("term", "bundle", "slot")})
    got = lexical.search(table, items, bundle=bundle, shard=shard)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, ITEMS)


def test_text_ids_and_empty_tables(spark):
    docs = [(f"d{i}", t) for i, t in corpus(30)]
    table = spark.createDataFrame(docs, "doc_id string, text string")
    items = spark.createDataFrame([(str(i), t) for i, t in ITEMS], "item_id string, text string")
    assert sorted(map(tuple, lexical.search(table, items, top=7).collect()), key=str) == plain(docs, [(str(i), t) for i, t in ITEMS], 7)
    assert lexical.search(table.where("false"), items).collect() == []
    assert lexical.search(table, items.where("false")).collect() == []
