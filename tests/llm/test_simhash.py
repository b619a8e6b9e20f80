"""Fingerprints, links and groups against plain loops."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rasterloom.llm import components, simhash


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    parts = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def roots(values):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def clusters(seed):
    drawn = np.random.default_rng(seed)
    values = {int(x) for x in drawn.integers(0, 2**64, 200, dtype=np.uint64)}
    for center in drawn.integers(0, 2**64, 30, dtype=np.uint64):
        for _ in range(drawn.integers(1, 50)):
            value = int(center)
            for bit in drawn.choice(64, drawn.integers(0, 6), replace=False):
                value ^= 1 << int(bit)
            values.add(value)
    return np.array(sorted(values | {int(center) ^ k for k in range(256)}), np.uint64)


@pytest.mark.parametrize("text", ["", "a", "a b", "A B c D", "É x\x1cy z w", " \t\n", "x " * 70_000, "one two three four five SIX"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(5))
def test_index_finds_all_links(seed):
    values = clusters(seed)
    rank = values.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    values = values[np.argsort(rank)]
    a, b = simhash.near(np.zeros(len(values), np.int64), values, 4)
    root = np.arange(len(values))
    root[a] = b
    assert root.tolist() == roots(values)


@pytest.mark.parametrize("group", [simhash.GROUP, 20])
def test_links_in_spark(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    values = clusters(9)
    signed = values.view(np.int64).tolist()
    found = components.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()
    got = {r.node: r.root for r in found}
    want = roots(values)
    groups = {}
    for v, r in zip(signed, want, strict=True):
        groups.setdefault(r, set()).add(got.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 600), (600, 700), (9, 9)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {600: 500, 700: 500}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base), (3, base.upper()), (9, base + " end"), (7, "other text of few words"), (8, None), (2, ""), (None, base), (11, " \n"), (7, "other text of few words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "key", "fp", "component", "__key_")})
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    assert all(int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in got)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (None, 3), (7, 7), (8, 2), (2, 2), (11, 2)}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 7]
    assert simhash.near_duplicates(docs.where("false")).collect() == []
