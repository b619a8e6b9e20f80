"""Phrases against plain loops, with few ranks and with all."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import collocations as co


def plain(docs, words=3, support=10, share=50, top=2000):
    counts = {}
    for lang, text in docs:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, words + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        rows, held = [], {g: n for g, n in f.items() if len(g) > 1 and n >= support}
        for g, a in held.items():
            if any(len(q) > len(g) and 100 * n >= share * a and any(q[i : i + len(g)] == g for i in range(len(q))) for q, n in held.items() if set(g) <= set(q)):
                continue
            score, _, left, right = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        n = sum(c for g, c in f.items() if len(g) == 1)
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus(seed, n):
    drawn = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["É", "日本", "\x1c", "a b"]
    weight = [1 / (i + 1) for i in range(len(words))]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    docs = []
    for i in range(n):
        text = "".join(drawn.choice([w, w.upper()]) + drawn.choice(ends) for w in drawn.choices(words, weight, k=drawn.randint(1, 60)))
        docs.append((drawn.choice(["en", "fr", None]), text + " New York City" * drawn.randint(0, 2)))
    return docs + [("en", None), ("en", ""), ("de", " .,"), ("xx", "same"), ("fr", "run on " * 30_000), docs[0], docs[0]]


@pytest.mark.parametrize(("words", "ranks", "side", "support"), [(3, 18, 9, 10), (3, 4, 2, 10), (2, 3, 3, 4), (4, 5, 2, 5), (3, 0, 1, 10)])
def test_against_loops(spark, words, ranks, side, support):
    docs = corpus(words * 7 + ranks, 120)
    table = spark.createDataFrame(docs, "lang string, text string").repartition(3).withColumns({c: F.lit(1) for c in ("n", "a", "symbol", "id")})
    got = co.collocations(table, words=words, support=support, top=40, ranks_log=ranks, side_log=side)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(docs, words, support, top=40)


def test_no_phrases(spark):
    table = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert co.collocations(table).collect() == [] and co.collocations(table.where("false")).collect() == []


def test_products_beyond_64_bits(spark):
    big = 3_000_000_007
    own = spark.createDataFrame([(1, big, "en", "a b", [big + 5], [big + 11])], "id long, n long, lang string, text string, heads array<long>, tails array<long>")
    assert co._scored(own, None, 50).first().score == 10**6 * big * big // ((big + 5) * (big + 11))


@pytest.mark.parametrize("side", [1, 3, 9])
def test_tiles_count_like_coordinates(side):
    drawn = np.random.default_rng(side)
    a, b = drawn.integers(0, 300, (2, 20_000)) // drawn.integers(1, 300, (2, 20_000))
    cells, n = co._tiled(a, b, 9, side)
    x, y, want = co._coordinates(a, b)
    tile, low = cells >> (2 * side), (1 << side) - 1
    first = (tile >> max(9 - side, 0)) << side | (cells >> side) & low
    second = (tile & ((1 << max(9 - side, 0)) - 1)) << side | cells & low
    order = np.lexsort((second, first))
    assert (first[order] == x).all() and (second[order] == y).all() and (n[order] == want).all()
