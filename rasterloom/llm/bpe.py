"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

All distinct words of a block lie end to end in one array. An inverted index holds, for each pending merge, the
positions whose pair it joins. Merges are applied in rank order, all positions of one merge at once; only the
neighbours of the joined positions get new pairs and enter the index. A pair that appears with a lower rank than
the merge just applied could be due before the rest of its word's merges, so such words are encoded again alone.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rasterloom.llm.common import blocks, column, emit, ship
from rasterloom.llm.pretokens import pretokens

_NONE = -1


class Merges:
    """A vocabulary as arrays: the pairs that merge, their ranks, and the bytes of each id."""

    def __init__(self, tokens: list[bytes], pairs: dict[tuple[int, int], tuple[int, int]], whole: bool):
        """``pairs``: (left id, right id) -> (rank, joined id). ``whole``: a word in the vocabulary is one token."""
        self.tokens, self.whole = tokens, whole
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.size = len(tokens) + 1  # the last is the edge of a word
        code = np.array([a * self.size + b for a, b in pairs], np.int64)
        order = np.argsort(code)
        self.code = code[order]
        self.rank = np.array([r for r, _ in pairs.values()], np.int64)[order]
        self.joined = {r: i for r, i in pairs.values()}
        self.pairs = pairs

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * self.size + right
        at = np.searchsorted(self.code, code)
        at[at == len(self.code)] = 0
        return np.where(self.code[at] == code, self.rank[at], _NONE)

    def alone(self, word: bytes) -> list[int]:
        """The ids of one word: the lowest rank first, the leftmost of equal ranks first."""
        sym = [int(self.byte_ids[b]) for b in word]
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        due = [(self.pairs[p][0], i) for i, p in enumerate(zip(sym, sym[1:], strict=False)) if p in self.pairs]
        heapq.heapify(due)
        while due:
            rank, i = heapq.heappop(due)
            if sym[i] == _NONE or nxt[i] == n or self.pairs.get((sym[i], sym[nxt[i]]), (_NONE,))[0] != rank:
                continue
            gone = nxt[i]
            sym[i], sym[gone], nxt[i] = self.joined[rank], _NONE, nxt[gone]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for left in (prv[i], i):
                if left >= 0 and nxt[left] < n and (found := self.pairs.get((sym[left], sym[nxt[left]]))):
                    heapq.heappush(due, (found[0], left))
        return [s for s in sym if s != _NONE]


def from_ranks(data: bytes) -> Merges:
    """A rank file: any two neighbours whose joined bytes are in the vocabulary merge, at the joined rank."""
    rows = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in data.splitlines() if line))
    tokens = [t for _, t in rows]
    if [r for r, _ in rows] != list(range(len(rows))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    ids = {t: i for i, t in enumerate(tokens)}
    pairs = {}
    for i, t in enumerate(tokens):
        for cut in range(1, len(t)):
            a, b = ids.get(t[:cut]), ids.get(t[cut:])
            if a is not None and b is not None:
                pairs[a, b] = (i, i)
    return Merges(tokens, pairs, whole=True)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in JSON vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def from_json(data: bytes) -> tuple[Merges, list[str]]:
    """A JSON vocabulary with its own list of merges, and its special strings."""
    held = json.loads(data)
    model, alphabet = held["model"], byte_alphabet()
    ids = model["vocab"]
    tokens = [b""] * (max(ids.values()) + 1)
    special = [t["content"] for t in held["added_tokens"]]
    for t, i in ids.items():
        tokens[i] = t.encode() if t in special else bytes(alphabet[c] for c in t)
    pairs = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        pairs[ids[a], ids[b]] = (rank, ids[a + b])
    return Merges(tokens, pairs, whole=bool(model.get("ignore_merges"))), special


def replay(words: list[bytes], model: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words end to end, and the number of ids of each word. No word is empty."""
    counts = np.zeros(len(words), np.int64)
    if not words:
        return np.zeros(0, np.int64), counts
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n = int(ends[-1])
    edge = model.size - 1
    sym = np.append(model.byte_ids[np.frombuffer(b"".join(words), np.uint8)], edge)
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    nxt[ends - 1], prv[starts] = n, n
    live = np.ones(n, bool)
    due = model.ranks_of(sym[:n], sym[nxt[:n]])  # the rank of the pair that begins here
    due = np.append(due, _NONE)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        lows = [0, *cuts.tolist()]
        for rank, low, high in zip(ranks[lows].tolist(), lows, [*lows[1:], len(at)], strict=True):
            if rank in index:
                index[rank].append(at[low:high])
            else:
                index[rank] = [at[low:high]]
                heapq.heappush(heap, rank)

    first = np.flatnonzero(due >= 0)
    if len(first):
        enter(first, due[first])
    again: list[np.ndarray] = []
    while heap:
        rank = heapq.heappop(heap)
        held = index.pop(rank)
        at = held[0] if len(held) == 1 else np.sort(np.concatenate(held))
        at = at[due[at] == rank]
        if not len(at):
            continue
        if len(at) > 1 and (chain := nxt[at[:-1]] == at[1:]).any():  # of overlapping pairs every other one
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(np.concatenate(([True], ~chain)), place, 0))
            at = at[(place - head) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = model.joined[rank]
        live[gone], due[gone] = False, _NONE
        nxt[at] = after
        prv[after] = at
        right = model.ranks_of(sym[at], sym[after])
        due[at] = right
        before = prv[at]
        own = before != n
        own[1:] &= after[:-1] != at[1:]  # that pair is the right one of the position before
        before = before[own]
        left = model.ranks_of(sym[before], sym[nxt[before]])
        due[before] = left
        at, ranks = np.concatenate((at, before)), np.concatenate((right, left))
        found = ranks >= 0
        at, ranks = at[found], ranks[found]
        if len(at):
            if (low := ranks < rank).any():
                again.append(np.searchsorted(ends, at[low], side="right"))
            enter(at, ranks)
    counts = np.add.reduceat(live.astype(np.int64), starts)
    ids = sym[:n][live]
    if again:
        own = {int(w): np.array(model.alone(words[w]), np.int64) for w in np.unique(np.concatenate(again))}
        cut = np.cumsum(counts) - counts
        pieces, last = [], 0
        for w, new in own.items():
            pieces += [ids[last : cut[w]], new]
            last = int(cut[w] + counts[w])
            counts[w] = len(new)
        ids = np.concatenate([*pieces, ids[last:]])
    return ids, counts


class Numbered(dict):
    """Numbers words in the order in which they first appear."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def encode_block(texts: list[str], model: Merges) -> Iterator[np.ndarray]:
    """The ids of each text, from one replay over the distinct words of all of them."""
    known = Numbered()
    rows = []
    for text in texts:
        words = pretokens(text)
        rows.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
    spelled = [w.encode() for w in known]
    del known
    single = np.array([model.ids.get(w, _NONE) if model.whole else _NONE for w in spelled], np.int64)
    rest = np.flatnonzero(single == _NONE)
    ids, few = replay([spelled[i] for i in rest], model)
    counts = np.ones(len(spelled), np.int64)
    counts[rest] = few
    starts = np.arange(len(spelled), dtype=np.int64) + len(ids)  # single tokens stand behind the others
    starts[rest] = np.cumsum(few) - few
    ids = np.concatenate((ids, single)).astype("<u4")
    for row in rows:
        many = counts[row]
        total = int(many.sum())
        yield ids[np.repeat(starts[row] - (np.cumsum(many) - many), many) + np.arange(total)]


def encode_decode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) of each row: ids as little-endian unsigned 32-bit integers, the bytes they decode to.

    ``model`` is the content of a rank file, whose size bounds what is handed to the tasks. A null text counts as
    empty: no tokens, empty ``ids`` and ``decoded``. Repeated rows give repeated results; other columns are not read,
    so their names cannot clash; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows)), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _cached(shared.value)

        def each():
            for block in blocks(batches):
                texts = [t or "" for t in block.column("text").to_pylist()]
                for key, ids in zip(block.column("id").to_pylist(), encode_block(texts, merges), strict=True):
                    decoded = b"".join(map(merges.tokens.__getitem__, ids.tolist()))
                    yield 4 * len(ids) + len(decoded), (key, len(ids), ids.tobytes(), decoded)

        yield from emit(schema, each())

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


_held: dict[int, Merges] = {}


def _cached(data: bytes) -> Merges:
    key = hash(data)
    if key not in _held:
        _held[key] = from_ranks(data)
    return _held[key]


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)
