"""Toxicity grades by a cumulative-link ordinal regression on sparse word features.

Words are counted in all labelled documents that are not held out, in and outside toxic ones; all that differ
significantly are the features. One weight vector serves all thresholds: P(grade > k) = logistic(w x - t_k),
t_1 < t_2 < ... The weights decay towards a multiple of the words' log odds ratios, so a rare word has the weight that its
counts give it. The labels say only whether a document is toxic, so its grade comes from how many of its words point to
toxicity.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.bpe import _arrow_type
from rasterloom.llm.common import blocks, column, emit, ship, sifted, stored
from rasterloom.llm.quality import held_out

#: Labelled rows that the weights are fitted on, at most, from the documents of so many labels: those with the smallest
#: hashes of their ids.
SAMPLE, DRAWN = 10_000, 50_000
#: Documents that must hold a word for it to be tested; the chance that any word without a difference becomes a feature, by
#: the log likelihood ratios of all tested words; the log odds ratio from which a feature points to toxicity.
SUPPORT, ALPHA, POINTS = 5, 0.05, 2.0
#: Features of the model, at most: those with the largest ratios. They bound what the driver and each task hold (about 200 bytes each).
FEATURES = 1 << 18
#: Pointing words from which a toxic document has grade 2 and 3.
GRADES = (5, 12)
#: Bytes of distinct words that a task counts at a time.
COUNTED = 8 << 20
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Sparse:
    """A matrix by its entries, for products with vectors."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.values, self.shape = rows, columns, values, shape

    def __matmul__(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * v[self.columns], self.shape[0])

    @property
    def T(self) -> Sparse:  # noqa: N802
        return Sparse(self.columns, self.rows, self.values, self.shape[::-1])


class Ordinal:
    """Weights shared by ordered thresholds."""

    def __init__(self, words: list[str], weights: np.ndarray, thresholds: np.ndarray):
        self.at = {w: i for i, w in enumerate(words)}
        self.weights, self.thresholds = weights, thresholds

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))

    def score(self, words: list[str]) -> float:
        found = Counter(self.at[w] for w in words if w in self.at)
        return float(sum(self.weights[i] * np.log1p(n) for i, n in found.items()))


def fit(x: np.ndarray | Sparse, y: np.ndarray, grades: int, steps: int = 600, rate: float = 0.05, decay: float = 3e-4, spread: float = 3e-4):
    """Weights and ordered thresholds by gradient steps on the mean log likelihood.

    ``decay`` draws the weights to zero, all alike or each by its own entry, ``spread`` the logarithms of the gaps.
    The first threshold is free; each further one is the one before plus the exponent of a free number, so they stay
    in order whatever the steps do.
    """
    w, first, gaps = np.zeros(x.shape[1]), 2.0, np.zeros(grades - 2)
    state = [[0.0, 0.0] for _ in range(3)]
    rows = np.arange(len(y))
    for step in range(1, steps + 1):
        t = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        s = x @ w
        edges = np.concatenate((np.full((len(y), 1), 1.0), 1 / (1 + np.exp(-np.clip(s[:, None] - t, -40, 40))), np.zeros((len(y), 1))), axis=1)
        high, low = edges[rows, y], edges[rows, y + 1]  # P(> y - 1) and P(> y)
        p = np.maximum(high - low, 1e-12)
        dhigh, dlow = high * (1 - high) / p, low * (1 - low) / p
        ds = -(dhigh - dlow) / len(y)
        dt = np.zeros(grades - 1)
        np.add.at(dt, np.maximum(y - 1, 0), np.where(y > 0, dhigh, 0) / len(y))
        np.add.at(dt, np.minimum(y, grades - 2), -np.where(y < grades - 1, dlow, 0) / len(y))
        slopes = [x.T @ ds + decay * w, dt.sum(), np.array([dt[k + 1 :].sum() for k in range(grades - 2)]) * np.exp(gaps) + spread * gaps]
        new = []
        for i, (value, g) in enumerate(zip((w, first, gaps), slopes, strict=True)):
            m, v = 0.9 * state[i][0] + 0.1 * g, 0.999 * state[i][1] + 0.001 * g * g
            state[i] = [m, v]
            new.append(value - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
        w, first, gaps = new
    return w, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, drawn: int = DRAWN, features: int = FEATURES,
) -> Ordinal:
    """A model from the labels that are not held out: words are counted over all of them in one scan, weights fitted on a sample.

    Weights come from ``sample`` rows at most, of the documents of ``drawn`` labels. Labels reach the texts by a join on the id, of
    any type, that broadcasts them below Spark's size threshold and else shuffles, deflated, the distinct words of the
    labelled texts, which a bitmap over their ids picks before. Rows without id
    or label teach nothing; of several labels of an id the largest counts; repeated documents count repeatedly.
    """
    spark = docs.sparkSession
    ship(spark)
    marked = labels.select(column(id_col).alias("id"), column(label_col).alias("label")).dropna()
    marked = marked.groupBy("id").agg(F.max("label").cast("int").alias("label")).where(~held_out(F.col("id")))
    marked = stored(marked, "labels")
    texts = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))

    kind, schema = texts.schema["id"].dataType.simpleString(), pa.schema([("id", _arrow_type(texts)), ("words", pa.binary())])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for block in blocks(batches):
                for i, text in zip(block.column("id").to_pylist(), block.column("text").to_pylist(), strict=True):
                    words = zlib.compress(" ".join(sorted(set(words_of(text)))).encode(), 1)
                    yield len(words), (i, words)

        yield from emit(schema, each())

    labelled = texts.select("id").join(marked, "id").select(F.xxhash64("id").alias("hash"))
    words = sifted(texts, F.xxhash64("id"), labelled).mapInArrow(distinct, f"id {kind}, words binary")
    found = words.join(marked, "id").select("label", "words").mapInArrow(_count, "word string, clean long, toxic long")
    counts = found.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # One pass over the counts: what is too rare to be a feature goes before the totals are known.
    held = counts.where((F.col("clean") + F.col("toxic") >= SUPPORT) | (F.col("word") == ""))
    total = F.first(F.when(F.col("word") == "", F.struct("clean", "toxic")), ignorenulls=True)
    held = stored(held, "word-counts")
    whole = held.agg(total.alias("n")).first()["n"]
    if not whole or not whole["clean"] or not whole["toxic"]:
        return Ordinal([], np.zeros(0), np.array([2.0, 3.0, 4.0]))
    a, b = F.col("toxic"), F.col("clean")
    share = (a + b) / (whole["toxic"] + whole["clean"])
    likely = a * F.log(a / (whole["toxic"] * share)), b * F.log(b / (whole["clean"] * share))
    ratio = 2 * sum(F.when(n > 0, x).otherwise(0.0) for n, x in zip((a, b), likely, strict=True))
    tested = held.where("word != ''")
    clear = NormalDist().inv_cdf(1 - ALPHA / max(tested.count(), 1) / 2) ** 2
    odds = [F.log((n + 0.5) / (whole[c] - n + 0.5)) for n, c in ((a, "toxic"), (b, "clean"))]
    clear = tested.where(ratio >= clear).orderBy(ratio.desc(), "word").limit(features)
    best = sorted(map(tuple, clear.select("word", (odds[0] - odds[1]).alias("odds")).collect()))
    few = marked.orderBy(F.xxhash64("id"), "id").limit(drawn)
    rows = texts.join(F.broadcast(few), "id")  # at most ``drawn`` rows of an id and a number
    return _weights(rows, [w for w, _ in best], np.array([o for _, o in best]), sample)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents that hold a word, by label, from their distinct words; those of the empty word are all documents."""
    schema = pa.schema([("word", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def rows(clean: Counter, toxic: Counter):
        return ((len(w) + 16, (w, clean[w], toxic[w])) for w in clean.keys() | toxic.keys())

    held, size = (Counter(), Counter()), 0
    for block in blocks(batches):
        for label, words in zip(block.column("label").to_pylist(), block.column("words").to_pylist(), strict=True):
            words = zlib.decompress(words).decode()
            own, size = held[label > 0], size + len(words)
            own.update(words.split())
            own[""] += 1
            if size >= COUNTED:
                yield from emit(schema, rows(*held))
                held, size = (Counter(), Counter()), 0
    yield from emit(schema, rows(*held))


def _weights(rows: DataFrame, words: list[str], odds: np.ndarray, sample: int) -> Ordinal:
    """``odds`` are the words' log odds ratios, which the weights decay towards."""
    spark = rows.sparkSession
    kind = rows.schema["id"].dataType.simpleString()
    schema = pa.schema([("id", _arrow_type(rows)), ("grade", pa.int32()), ("at", pa.binary()), ("x", pa.binary())])
    shared = spark.sparkContext.broadcast({w: (i, o >= POINTS) for i, (w, o) in enumerate(zip(words, odds.tolist(), strict=True))})

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def each():
            for block in blocks(batches):
                for i, label, text in zip(*(block.column(c).to_pylist() for c in ("id", "label", "text")), strict=True):
                    found = Counter(known[w] for w in words_of(text) if w in known)
                    many = sum(n for (_, points), n in found.items() if points)
                    grade = 1 + sum(many >= g for g in GRADES) if label > 0 else 0
                    pairs = sorted((at, n) for (at, _), n in found.items())
                    at, x = (np.array([p[k] for p in pairs], t) for k, t in enumerate((np.int32, np.float64)))
                    yield 12 * len(pairs), (i, grade, at.tobytes(), np.log1p(x).tobytes())

        yield from emit(schema, each())

    found = rows.mapInArrow(vectors, f"id {kind}, grade int, at binary, x binary")
    found = found.orderBy(F.xxhash64("id"), "id", "at", "x", "grade").limit(sample).collect()
    at = [np.frombuffer(r["at"], np.int32) for r in found]
    own = np.repeat(np.arange(len(found)), [len(a) for a in at])
    columns, values = np.concatenate([np.zeros(0, np.int32), *at]), np.concatenate([np.zeros(0), *(np.frombuffer(r["x"]) for r in found)])
    # One more column has the log odds of the words found: its weight is free, those of the words are what differs from it.
    unit = odds / max(np.abs(odds).max(initial=0.0), 1.0)
    both = Sparse(
        np.concatenate((own, own)), np.concatenate((columns, np.full(len(columns), len(words)))),
        np.concatenate((values, values * unit[columns])), (len(found), len(words) + 1),
    )
    decay = np.append(np.full(len(words), 1 / max(len(found), 1)), 0.0)
    weights, thresholds = fit(both, np.array([r["grade"] for r in found], int), len(GRADES) + 2, decay=decay)
    return Ordinal(words, weights[:-1] + weights[-1] * unit, thresholds)


def grade(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, grade, toxic, p_toxic) of each row.

    ``severity`` is the expected grade, 0 to 3; ``grade`` the likeliest one; ``toxic`` that a grade above 0 is at least
    as likely as not. A null text counts as empty; an empty text has what the thresholds alone say. Repeated rows give
    repeated results; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows)), ("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for block in blocks(batches):
            texts = block.column("text").to_pylist()
            above = own.above(np.array([own.score(words_of(t)) for t in texts]))
            each = np.concatenate((np.ones((len(texts), 1)), above), axis=1) - np.concatenate((above, np.zeros((len(texts), 1))), axis=1)
            values = zip(above.sum(axis=1).tolist(), each.argmax(axis=1).tolist(), above[:, 0].tolist(), strict=True)
            yield from emit(schema, ((32, (i, *v)) for i, v in zip(block.column("id").to_pylist(), values, strict=True)))

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, severity double, grade int, p_toxic double")
    return out.select(F.col("id").alias(id_col), "severity", "grade", (F.col("p_toxic") >= 0.5).alias("toxic"), "p_toxic")
