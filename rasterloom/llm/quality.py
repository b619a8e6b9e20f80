"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network in numpy.

Each term has a sparse random index vector, drawn from its hash. A word's vector is the sum of the index vectors of
its own shape and of its neighbours' words and shapes over the whole corpus. Words share a fixed number of vectors, so
the model has a fixed size. Tasks sum over what they read; the sums meet by vector, not by task.
A document is the mean of its words' vectors and of its shapes' index vectors. The network is fitted on a bounded sample
of labelled rows and its temperature on another part of that sample.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.bpe import _arrow_type
from rasterloom.llm.common import blocks, column, emit, ship

BUCKETS, DIMS, ENTRIES = 8192, 64, 4
#: Labelled rows that the network is fitted on, at most: those with the smallest hashes of their ids.
SAMPLE = 10_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 128, 0.01
#: The mean of so few words is drawn halfway to that of the sample; without words a text is as the sample's mean.
SHRINK = 8
#: Signs of a piece. A token of more signs, a run of like characters being one, is several pieces, each with its own word and shape.
PIECE = 8
#: Longer tokens are not kept in the table of known ones, which does not change their pieces.
LONG = 64
_TOKENS = 1 << 16
_KNOWN = 1 << 18


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each term's index vector."""
    drawn = np.random.default_rng(7)
    return drawn.integers(0, DIMS, (BUCKETS, ENTRIES)), drawn.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


PLACES, SIGNS = _index_vectors()
_MARKS = ".,;:!?$%&*#@|()[]{}<>\"'-_=+/"
_RUNS = [(re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}"), "A"), (re.compile(r"\d+"), "9")]
_CORE, _TWICE = re.compile(r"[^\W_]+"), re.compile(r"(.)\1+")
_SIGN = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+|[A-ZÀ-ÖØ-Þ]+|\d+|(.)\1*", re.DOTALL)


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % BUCKETS


def pieces(token: str) -> list[str]:
    """A token of at most PIECE signs as it is, others cut after each PIECE signs; words of letters only are one piece."""
    if len(token) <= PIECE or token.isalpha():
        return [token]
    cuts = [m.start() for m in _SIGN.finditer(token)][::PIECE]
    return [token[a:b] for a, b in zip(cuts, [*cuts[1:], len(token)], strict=True)]


class Terms(dict):
    """The buckets of a token's pieces, each in one number: word, shape, and shape as a repeat of the piece before it.

    A token of several pieces has -1.
    """

    def __missing__(self, token: str) -> int:
        if len(self) > _KNOWN:
            self.clear()
        cut = pieces(token)
        self[token] = found = self.code(token) if len(cut) == 1 else -1
        return found

    def codes(self, tokens: list[str]) -> np.ndarray:
        """The numbers of all pieces, in order."""
        found = [self[t] if len(t) <= LONG else -1 for t in tokens]
        if -1 in found:
            found = [x for t, c in zip(tokens, found, strict=True) for x in ([c] if c >= 0 else map(self.code, pieces(t)))]
        return np.array(found, np.int64)

    def code(self, token: str) -> int:
        core = token.strip(_MARKS)
        if core.isalpha():
            word = core.lower()
            kind = "a" if word == core else "A" if core.isupper() and len(core) > 1 else "Aa" if core[1:] == word[1:] else "x"
            shape = kind if core == token else token.replace(core, kind, 1)
        else:
            word = "".join(_CORE.findall(token)).lower()
            shape = token
            for run, sign in _RUNS:
                shape = run.sub(sign, shape)
        return _bucket("w" + word) * BUCKETS * BUCKETS + _shape_code(shape)


@lru_cache(1 << 16)
def _shape_code(shape: str) -> int:
    """Buckets of a shape and of its repeat; runs of one sign are one."""
    shape = _TWICE.sub(r"\1", shape)
    return _bucket("s" + shape) * BUCKETS + _bucket("r" + shape)


def token_terms(text: str, known: Terms) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of words and of shapes of a text, in parts of bounded length."""
    tokens, last = text.split(), -1
    found = (known.codes(tokens[low : low + _TOKENS]) for low in range(0, len(tokens), _TOKENS))
    for codes in (c[low : low + _TOKENS] for c in found for low in range(0, len(c), _TOKENS)):
        same = np.concatenate(([last], codes[:-1])) == codes
        both, again = np.divmod(codes, BUCKETS)
        words, shapes = np.divmod(both, BUCKETS)
        yield words, np.where(same, again, shapes)
        last = codes[-1]


def add_contexts(sums: np.ndarray, words: np.ndarray, shapes: np.ndarray) -> None:
    """Add to each word's vector the index vectors of its own shape and of its neighbours."""
    real = words >= 0  # not what stands between two texts
    near = real[1:] & real[:-1]
    first, then = words[1:][near], words[:-1][near]
    pairs = ((words[real], shapes[real]), (first, then), (first, shapes[:-1][near]), (then, first), (then, shapes[1:][near]))
    for left, right in pairs:
        if len(left):
            at = left[:, None] * DIMS + PLACES[right]
            sums += np.bincount(at.ravel(), SIGNS[right].ravel(), sums.size)


def pool(text: str, vectors: np.ndarray, known: Terms) -> np.ndarray:
    """The mean of the vectors of a text's words and of the index vectors of their shapes, and how far to trust it."""
    total, n = np.zeros(2 * DIMS), 0
    for words, shapes in token_terms(text, known):
        total[:DIMS] += vectors[words].sum(axis=0)
        total[DIMS:] += np.bincount(PLACES[shapes].ravel(), SIGNS[shapes].ravel(), DIMS)
        n += len(words)
    return np.append(total / max(n, 1), n / (n + SHRINK))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """One vector for each bucket, of length one if any word fell there, from all texts."""
    ship(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known = np.zeros(BUCKETS * DIMS), Terms()
        for block in blocks(batches, 4 << 20):
            parts = [p for text in block.column(0).to_pylist() if text for p in token_terms(text, known)]
            for words, shapes in _packed(parts):
                add_contexts(sums, words, shapes)
        used = sums.reshape(BUCKETS, DIMS)
        rows = np.flatnonzero(used.any(axis=1))
        for low in range(0, len(rows), 2048):
            cut = rows[low : low + 2048]
            yield pa.record_batch(
                [pa.array(cut), pa.array([r.astype("<f8").tobytes() for r in used[cut]], pa.binary())], names=["bucket", "sums"]
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(data, "<f8")
                held[bucket] = held[bucket] + own if bucket in held else own
        if held:
            yield pa.record_batch(
                [pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["bucket", "sums"]
            )

    kind = "bucket long, sums binary"
    sums = docs.select(column(text_col)).mapInArrow(partial, kind).repartition("bucket").mapInArrow(total, kind)
    out = np.zeros((BUCKETS, DIMS))
    for row in sums.collect():  # at most BUCKETS rows
        out[row["bucket"]] = np.frombuffer(row["sums"], "<f8")
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def _packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Many short texts as few arrays, -1 between two texts."""
    gap = np.array([-1])
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for words, shapes in parts:
        held.append((np.append(words, gap), np.append(shapes, gap)))
        size += len(words)
        if size >= 4 * _TOKENS:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


class Network:
    """A hidden layer and a logistic output with a temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = mean, scale, w1, b1, w2, b2, temperature

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return (x[:, :-1] - self.mean) / self.scale * x[:, -1:]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.inputs(x) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Fit on four fifths of the rows, set the temperature on the others. One class only: its share, whatever the text."""
    wide = x.shape[1] - 1
    scale = x[:, :-1].std(axis=0) if len(x) else np.ones(wide)
    mean = x[:, :-1].mean(axis=0) if len(x) else np.zeros(wide)
    drawn = np.random.default_rng(seed)
    net = Network(
        mean, np.where(scale > 1e-9, scale, 1.0), drawn.normal(0, wide**-0.5, (wide, HIDDEN)),
        np.zeros(HIDDEN), drawn.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
    )
    if len(set(y.tolist())) < 2:
        net.w2, net.b2 = np.zeros(HIDDEN), 0.0 if not len(y) else (3.0 if y[0] else -3.0)
        return net
    order = drawn.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    state = {k: [np.zeros_like(getattr(net, k)) for _ in range(2)] for k in ("w1", "b1", "w2", "b2")}
    step = 0
    for _ in range(EPOCHS):
        drawn.shuffle(used)
        for low in range(0, len(used), BATCH):
            rows = used[low : low + BATCH]
            z = net.inputs(x[rows])
            h = np.tanh(z @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40)))
            d = (p - y[rows]) / len(rows)
            dh = d[:, None] * net.w2 * (1 - h * h)
            slope = {"w1": z.T @ dh + 1e-4 * net.w1, "b1": dh.sum(axis=0), "w2": h.T @ d + 1e-4 * net.w2, "b2": d.sum()}
            step += 1
            for k, g in slope.items():
                m, v = state[k]
                state[k] = [0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g]
                m, v = state[k]
                setattr(net, k, getattr(net, k) - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    if len(held):
        logits, truth = net.logits(x[held]), y[held]
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        net.temperature = float(min(choices, key=lambda t: np.mean(np.logaddexp(0, np.where(truth == 1, -logits, logits) / t))))
    return net


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts, and a network fitted on at most ``sample`` labelled rows that are not held out."""
    vectors = word_vectors(docs, text_col)
    # Of several labels of a document the largest counts; null labels and ids are left out.
    marked = labels.select(column(id_col).alias("id"), column(label_col).alias("label")).dropna()
    marked = marked.groupBy("id").agg(F.max("label").alias("label")).where(~held_out(F.col("id")))
    marked = marked.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(marked), "id").select("label", "text")  # at most ``sample`` rows of two numbers
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        schema = pa.schema([("label", pa.int64()), ("x", pa.binary())])

        def each():
            for block in blocks(batches):
                for label, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                    yield 1100, (int(label), pool(text, shared.value, known).tobytes())

        yield from emit(schema, each())

    # Repeated rows may exceed the sample; the first ones in a fixed order stay.
    found = rows.mapInArrow(run, "label long, x binary").orderBy(F.xxhash64("x"), "x", "label").limit(sample).collect()
    x = np.array([np.frombuffer(r["x"]) for r in found]).reshape(len(found), 2 * DIMS + 1)
    return vectors, fit(x, np.array([float(r["label"]) for r in found]))


def held_out(key):
    """The third of the ids whose labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def score(docs: DataFrame, model: tuple[np.ndarray, Network], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of each row.

    A null text counts as empty; an empty text scores as the mean of the sample. Repeated rows give repeated
    results. Other columns are not read. A null id is not held out. Without labels every score is 0.5.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows)), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for block in blocks(batches):
            values = _scores(block.column("text").to_pylist(), shared.value, known)
            rows = zip(block.column("id").to_pylist(), values.tolist(), strict=True)
            yield from emit(schema, ((16, row) for row in rows))

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _scores(texts: list[str], model: tuple[np.ndarray, Network], known: Terms) -> np.ndarray:
    vectors, net = model
    return net.scores(np.array([pool(t or "", vectors, known) for t in texts]).reshape(len(texts), 2 * DIMS + 1))


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], text_col: str = "text") -> DataFrame:
    """The rows with a score of 0.5 or more, with all their columns; they never leave their task."""
    spark = docs.sparkSession
    ship(spark)
    shared, at = spark.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for batch in batches:
            if batch.num_rows:
                good = _scores(batch.column(at).to_pylist(), shared.value, known) >= 0.5
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
