"""Similar shingle sets against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import common, jaccard


def plain(docs, width=5, share=80):
    sets = []
    for _, text in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= share * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            r = find(k)
            least[r] = min(i, least.get(r, i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def corpus(seed, n):
    drawn = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = drawn.choices(words, k=60)
    docs, at = [], iter(range(10 * n, 0, -1))
    for _ in range(n):
        base = drawn.choices(words, k=drawn.choice([1, 3, 4, 5, 6, 8, 20, 80, 200]))
        if drawn.random() < 0.4:
            base = base[: len(base) // 2] + passage[: drawn.randint(5, 60)] + base[len(base) // 2 :]
        for _ in range(drawn.choice([1, 1, 2, 12])):
            own = list(base)
            for _ in range(drawn.randint(0, max(1, len(own) // 30))):
                own[drawn.randrange(len(own))] = drawn.choice(words)
            if drawn.random() < 0.3:
                own = own[drawn.randint(0, len(own) // 10) :]
            docs.append((next(at), drawn.choice([" ".join(own), "\n".join(own).upper()])))
    base = drawn.choices(words, k=150)  # a text, its near copies, and copies just too far from all
    for i in range(60):
        own = list(base)
        for k in drawn.sample(range(150), [0, 1, 2, 3, 4, 5][i % 6]):
            own[k] = drawn.choice([f"u{i}-{k}", f"u{i}-{k}", f"u{k}"])
        docs.append((next(at), " ".join(own)))
    chain = drawn.choices(words, k=300)  # each is near the next, the ends are not
    docs += [(next(at), " ".join(chain[i * 10 : 200 + i * 10])) for i in range(10)]
    return docs + [(next(at), None), (next(at), ""), (next(at), " \n"), (None, docs[0][1]), (docs[3][0], docs[3][1]), (docs[4][0], "other"), (None, "alone here"), (next(at), "w1 " * 50_000), (next(at), "x\x1cy"), (next(at), "x y")]


@pytest.mark.parametrize(("seed", "width", "share", "compared"), [(1, 5, 80, 1 << 21), (2, 5, 80, 64), (3, 2, 50, 1 << 21), (4, 3, 95, 999)])
def test_against_loops(spark, seed, width, share, compared):
    docs = corpus(seed, 150)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("id", "key", "n", "c", "__id")})
    got = jaccard.similar(table, shingle=width, share=share, compared=compared)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, width, share)


def test_text_ids_and_empty_tables(spark):
    docs = [("b", "one two three four five six"), ("a", "ONE two three four five six"), ("c", None)]
    table = spark.createDataFrame(docs, "doc_id string, text string")
    assert sorted(map(tuple, jaccard.similar(table).collect())) == [("a", 2, "a"), ("b", 2, "a"), ("c", 0, "c")]
    assert jaccard.similar(table.where("false")).collect() == []


def test_prefixes_alone_find_all(spark):
    """Without the groups that link copies ahead, the prefixes must find every link."""
    docs = [(i, t) for i, (_, t) in enumerate(corpus(7, 80)) if t and t.split()]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    sets = jaccard._sets(table, table.select(F.lit(b"").alias("key"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), F.lit(1).alias("rarity")), "doc_id", "text", 5)
    apart = jaccard._component(sets, None).withColumn("unit", F.col("c"))
    found = {tuple(r) for r in jaccard._candidates(jaccard._prefixes(apart, 80), 80).collect()}
    held = {r.c: set(r.shingles) for r in sets.collect()}
    want = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b])}
    assert want <= found and len(want) > 50
    met = {(a, b) for a in held for b in held if a < b and held[a] & held[b]}
    assert found <= met and len(found) < len(met) / 2


def test_copies_around_a_pivot(spark):
    """Copies with one to six edits, each of its own word or of a few words: pairs that only lack the same are no candidates."""
    drawn = random.Random(5)
    base = drawn.choices([f"w{i}" for i in range(3000)], k=110)
    docs = [(0, " ".join(base))]
    for i in range(1, 400):
        own = list(base)
        for k in drawn.sample(range(110), 1 + i % 6):
            own[k] = f"u{i}" if i % 2 else f"v{drawn.randrange(3)}"
        if i % 7 == 0:
            del own[drawn.randrange(110)]
        docs.append((i, " ".join(own)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.similar(table).collect()), key=str) == plain(docs)
    sets = jaccard._sets(table, table.select(F.lit(b"").alias("key"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"), F.lit(1).alias("rarity")), "doc_id", "text", 5)
    pivoted = jaccard._pivoted(jaccard._component(sets, None), 80)[1]
    # No component is known ahead, so every link with a class that is far from the pivot must be found.
    got = {tuple(sorted(r)) for r in jaccard._within(sets.select("c", F.col("c").alias("component")), pivoted, 80).collect()}
    held, at = {r.c: set(r.shingles) for r in sets.collect()}, {r.c: r.pivot for r in pivoted.collect()}
    near = lambda x, y: 100 * len(held[x] & held[y]) >= 80 * len(held[x] | held[y])
    far = {c for c, p in at.items() if not near(c, p)}
    want = {(x, y) for x in at for y in at if x < y and at[x] == at[y] and (x in far or y in far) and near(x, y)}
    assert want and got == want


def test_only_chosen_texts_are_shuffled(spark, monkeypatch):
    """Sets come from the chosen documents, which are found without a join that shuffles every text."""
    plans = {}
    monkeypatch.setattr(jaccard, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and common.stored(df, name))
    base = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*base[:-1], f"own{i}"])) for i in range(40)] + [(None, " ".join(base))]
    docs += [(i, " ".join(f"x{i}-{k}" for k in range(60))) for i in range(100, 500)] + [(100, "alone")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = jaccard.similar(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got), key=str) == plain(docs)
    plan = plans["sets"].split("== Physical Plan ==")[1]
    assert "LeftSemi" not in plan and "BroadcastHashJoin" in plan[plan.index("MapInArrow") :]
