"""Classifiers by held-out accuracy, graphs by recall."""

import statistics
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import common, hnsw, quality, toxicity
from rasterloom.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_quality(spark, tables):
    docs, labels = tables
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    own = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in rows) and len(rows) == docs.count()
    assert sum(r.predicted == truth[r.doc_id] for r in own) >= 0.97 * len(own)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (4, "y " * 200_000), (4, "y " * 200_000)], "doc_id long, text string")
    odd = odd.withColumns({c: F.lit(9) for c in ("id", "score", "held_out", "label")})
    got = quality.score(odd, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.score(odd.where("false"), model).collect() == []


def test_quality_without_labels(tables):
    docs, labels = tables
    model = quality.train(docs.limit(20), labels.where("false"))
    assert {r.score for r in quality.score(docs.limit(5), model).collect()} == {0.5}


def test_labels_of_the_held_out_third_are_not_learned(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs.limit(150), x)[1] for x in (labels, turned))
    assert np.array_equal(a.w1, b.w1) and a.temperature == b.temperature


def test_word_vectors_cover_all_texts(spark):
    docs = spark.createDataFrame([("red fox",), ("red fox",), (None,), ("",)], "text string")
    vectors = quality.word_vectors(docs)
    sums, known = np.zeros(quality.BUCKETS * quality.DIMS), quality.Terms()
    parts = [p for _ in range(2) for p in quality.token_terms("red fox", known)]
    for words, shapes in quality._packed(parts):
        quality.add_contexts(sums, words, shapes)
    want = sums.reshape(quality.BUCKETS, quality.DIMS)
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(vectors, want / np.where(norm > 0, norm, 1), atol=1e-6)


def test_every_character_of_a_long_token_enters():
    """Changes anywhere in a text without white space change its shapes, whatever its word vectors."""
    none = np.zeros((quality.BUCKETS, quality.DIMS), np.float32)
    text = "aB3+" * 60
    base = quality.pool(text, none, quality.Terms())
    for i in range(len(text)):
        other = quality.pool(text[:i] + "=" + text[i + 1 :], none, quality.Terms())
        assert not np.allclose(base, other), i
    one, other = "a.B-c/D:e_F+g", "a.B-c/D:e_9=9"
    assert not np.allclose(quality.pool(one, none, quality.Terms()), quality.pool(other, none, quality.Terms()))
    for n in (63, 64, 65, 1000):  # one rule for all lengths
        assert len(next(quality.token_terms("x" * n, quality.Terms()))[0]) == 1
        assert len(next(quality.token_terms("x1" * n, quality.Terms()))[0]) == -(-2 * n // quality.PIECE)
        assert "".join(quality.pieces("aB" * n + "!")) == "aB" * n + "!"
    assert sum(len(words) for words, _ in quality.token_terms("a1" * 500_000, quality.Terms())) == 125_000


def test_ordinal_fit():
    drawn = np.random.default_rng(0)
    x = drawn.normal(size=(3000, 4))
    y = np.digitize(x @ [2.0, -1.0, 0.5, 0.0] + drawn.logistic(size=3000), [-1.0, 1.0, 3.0])
    w, t = toxicity.fit(x, y, 4)
    assert np.allclose(w, [2.0, -1.0, 0.5, 0.0], atol=0.2) and np.allclose(t, [-1, 1, 3], atol=0.2) and (np.diff(t) > 0).all()


def test_toxicity(spark, tables):
    words = ["awful", "vile", "nasty", "foul"]
    drawn = np.random.default_rng(2)
    rows, marks = [], []
    for i in range(600):
        text = [f"w{n}" for n in drawn.integers(0, 300, 40)]
        toxic = i % 5 == 0
        if toxic:
            text += drawn.choice(words, drawn.integers(3, 20)).tolist()
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.grade(docs, model).collect()}
    own = [i for i in range(600) if held(i)]
    assert sum(got[i].toxic == (i % 5 == 0) for i in own) >= 0.98 * len(own)
    mild, harsh = spark.createDataFrame([(1, "awful vile nasty")], "doc_id long, text string"), " ".join(words * 8)
    pair = mild.unionByName(spark.createDataFrame([(2, harsh), (3, None), (3, ""), (None, "x")], "doc_id long, text string"))
    pair = pair.withColumns({c: F.lit(0) for c in ("id", "severity", "label")})
    out = {r.doc_id: r for r in toxicity.grade(pair, model).collect()}
    assert 0 < out[3].severity < out[1].severity < out[2].severity <= 3 and not out[3].toxic
    assert toxicity.grade(pair.where("false"), model).collect() == []
    empty = toxicity.train(docs, labels.where("false"))
    assert not any(r.toxic for r in toxicity.grade(docs.limit(5), empty).collect())


def test_toxicity_of_documents_with_rare_words_only(spark):
    """A few words of nearly all toxic documents, and many words each of which few toxic documents hold."""
    drawn = np.random.default_rng(6)
    common, rare = ["awful", "vile", "nasty"], [f"rare{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rows, marks = [], []
    for i in range(6000):
        text = [f"w{chr(97 + n // 20)}{chr(97 + n % 20)}" for n in drawn.integers(0, 300, 30)]
        if i % 5 == 0:
            text += drawn.choice(rare, 4).tolist() if i % 25 == 0 else common + drawn.choice(rare, 1).tolist()
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert set(common) <= model.at.keys() and len(model.at.keys() & set(rare)) >= 100
    assert all(model.weights[i] > 0 for w, i in model.at.items() if w in common + rare)
    got = {r.doc_id: r.toxic for r in toxicity.grade(docs, model).collect()}
    only = [i for i in range(0, 6000, 25) if held(i)]
    assert len(only) > 50 and sum(got[i] for i in only) >= 0.95 * len(only)
    clean = [i for i in range(6000) if i % 5 and held(i)]
    assert sum(got[i] for i in clean) <= 0.01 * len(clean)


def test_toxicity_by_loops_with_text_ids(spark):
    """Features are the words that plain counts call significant; ids are texts; grades follow the thresholds."""
    drawn = np.random.default_rng(9)
    rows = [(f"d{i}", " ".join([f"w{chr(97 + n)}" for n in drawn.integers(0, 26, 12)] + ["vile"] * (i % 4 == 0) + ["mean"] * (i % 8 == 0))) for i in range(500)]
    rows += [rows[4], ("d5", None), (None, "vile vile"), ("long", "vile " * 100_000)]
    marks = [(f"d{i}", int(i % 4 == 0)) for i in range(500)] + [("d4", 0), ("d3", None), (None, 1), ("long", 1), ("gone", 1)]
    docs, labels = spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(marks, "doc_id string, toxic int")
    model = toxicity.train(docs.repartition(3), labels)
    known = {}
    for i, label in marks:
        if i is not None and label is not None and not held(i):
            known[i] = max(label, known.get(i, 0))
    own = [(known[i], set((text or "").split())) for i, text in rows if i in known]
    n, total = [{}, {}], [0, 0]
    for label, words in own:
        total[label] += 1
        for w in words:
            n[label][w] = n[label].get(w, 0) + 1
    tested = {w for w in n[0].keys() | n[1].keys() if n[0].get(w, 0) + n[1].get(w, 0) >= toxicity.SUPPORT}
    clear = statistics.NormalDist().inv_cdf(1 - toxicity.ALPHA / len(tested) / 2) ** 2

    def ratio(w):
        both = [n[k].get(w, 0) for k in (0, 1)]
        return 2 * sum(x * np.log(x / (t * sum(both) / sum(total))) for x, t in zip(both, total, strict=True) if x)

    assert model.at.keys() == {w for w in tested if ratio(w) >= clear} == {"vile", "mean"}
    strongest = max(model.at, key=ratio)
    assert toxicity.train(docs, labels, features=1).at.keys() == {strongest}
    assert toxicity.train(docs, labels, sample=50, drawn=100).at.keys() == model.at.keys()
    out = toxicity.grade(docs, model).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    texts = {i: t or "" for i, t in rows}
    for r in out:
        score = sum(model.weights[model.at[w]] * np.log1p(texts[r.doc_id].split().count(w)) for w in model.at)
        above = 1 / (1 + np.exp(-np.clip(score - model.thresholds, -40, 40)))
        assert np.isclose(r.severity, above.sum()) and r.toxic == (above[0] >= 0.5)


def test_sifting_keeps_all_wanted_rows_and_few_others(spark):
    ids = spark.range(100_000).select((F.col("id") * 7919 - 300_000_000).alias("id"))
    wanted = ids.where("id % 50 = 0").select(F.xxhash64("id").alias("hash"))
    got = {r.id for r in common.sifted(ids, F.xxhash64("id"), wanted).collect()}
    assert got >= {r.id for r in ids.where("id % 50 = 0").collect()} and len(got) < 2_100
    assert common.sifted(ids, F.xxhash64("id"), wanted, bits=1 << 15).where("id % 50 = 0").count() == 2_000
    assert common.sifted(ids, F.xxhash64("id"), wanted.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_toxicity_shuffles_no_text(spark, monkeypatch, kind):
    """Where labels are too many to broadcast, distinct words of labelled texts go to them; ids may differ in type."""
    plans = {}
    monkeypatch.setattr(toxicity, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and common.stored(df, name))
    rows = [(i, "plain words vile" if i % 3 == 0 else "plain words") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 600, 2)], "doc_id long, toxic int").withColumn("doc_id", F.col("doc_id").cast(kind))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = toxicity.train(docs, labels)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert model.at.keys() == {"vile"}
    plan = plans["word-counts"].split("== Physical Plan ==")[1]
    joined = plan[plan.index("SortMergeJoin") :]
    assert "MapInArrow" in joined[: joined.index("BroadcastHashJoin")]


def test_words_of_all_labels_are_counted(spark):
    """Two words of twelve documents, all behind the labels that weights are fitted on."""
    ids = spark.range(90_000).where(~quality.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id")
    ids = [r.id for r in ids.collect()]
    assert len(ids) > 50_100
    late = set(ids[-12:])
    texts = ["plain words here", *(f"plain words awful{c} here" for c in "abcdefghij"), "plain words zounds gadzooks here"]
    kinds = [(i, 11 if i in late else 1 + i // 10 % 10 if i % 10 == 0 else 0) for i in ids]
    docs = spark.createDataFrame([(i, texts[k]) for i, k in kinds], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k > 0)) for i, k in kinds], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert {"awfula", "zounds"} <= model.at.keys() and model.weights[model.at["zounds"]] > 0
    pair = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.toxic for r in toxicity.grade(pair, model).collect()} == {i: i > 0 for i in range(12)}


def test_graph_recall():
    drawn = np.random.default_rng(1)
    vectors = drawn.normal(size=(3000, 24)) * drawn.random((3000, 1))
    levels, graphs = hnsw.build(vectors)
    assert all((g[levels < level] == -1).all() for level, g in enumerate(graphs))
    queries = vectors[::30]
    places, scores = hnsw.search(vectors, levels, graphs, queries, 20)
    true = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(places, true, strict=True)]) >= 0.95
    assert np.allclose(scores, np.take_along_axis(queries @ vectors.T, places, 1))
    packed = hnsw._unpacked(24, *hnsw._packed(vectors, levels, graphs), hnsw.LINKS)
    assert all((a == b).all() for a, b in zip(packed[2], graphs, strict=True))


def nearest_by_loops(rows, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(v)] = None
    return {
        (i, v): [j for _, j in sorted((-float(np.dot(v, w)), j) for j, w in good if j != i and len(w) == len(v))[:k]]
        for i, v in good
        if i % 20 == 0
    }


def test_nearest(spark):
    drawn = np.random.default_rng(4)
    single = lambda x: [float(np.float32(y)) for y in x]
    rows = [(i, single(drawn.normal(size=8) * drawn.random())) for i in range(400)]
    same = single(drawn.normal(size=8))
    rows += [(600 + i, same) for i in range(200)] + [(5, rows[5][1]), (None, same), (2000, None), (2020, []), (2040, [0.0] * 8)]
    rows += [(2060, [1.0, None]), (2080, [1.0, float("nan")]), (2100, [1.0, 2.0]), (2101, [1.0, 2.0]), (2120, [1.0, float("inf")])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame = frame.withColumns({c: F.lit(1) for c in ("rank", "point", "v", "id", "dim")})
    got = {}
    for r in sorted(hnsw.nearest(frame, shard=200).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {i: near for (i, _), near in nearest_by_loops(rows).items() if near}
    assert got.keys() == want.keys() and all(len(got[i]) == len(want[i]) for i in want)
    assert np.mean([len(set(got[i]) & set(want[i])) / len(want[i]) for i in want]) >= 0.95
    assert got[600] == list(range(601, 621)) and got[620][:3] == [600, 601, 602]
    assert hnsw.nearest(frame.where("false")).collect() == []


def spread_vectors(kind):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(1500, 16))
    if kind == "log-normal":
        vectors *= np.exp(4 * rng.normal(size=(1500, 1)))
    elif kind == "one long":
        vectors[7] *= 1e30
    else:
        vectors[7], vectors[11], vectors[13] = 0, 0, 0
        vectors[7, 0], vectors[11, 3], vectors[13, 5] = 1e200, 1e-200, 5e-324
    return vectors


@pytest.mark.parametrize("kind", ["log-normal", "one long", "extreme"])
def test_lengths_of_any_size(spark, kind):
    vectors = spread_vectors(kind)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in hnsw.nearest(frame).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    assert len(found) == 75
    for i, near in found.items():
        near.sort()
        assert [n for n, *_ in near] == list(range(1, 21))
        scores = (vectors * vectors[i]).sum(axis=1)
        assert np.allclose([s for *_, s in near], scores[[j for _, j, _ in near]], rtol=1e-9, atol=0)
        scores[i] = -np.inf
        hits += len({j for _, j, _ in near} & set(np.lexsort((np.arange(len(scores)), -scores))[:20].tolist()))
    assert hits >= 0.95 * 20 * len(found)
