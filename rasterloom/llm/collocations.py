"""Phrase collocations by direct-address tiling.

Symbols (words, later frequent pairs) are ranked by how often they occur. A pair of ranked symbols is a cell of a tile: a
run of first ranks by a run of second ranks. Where a block of text fills a tile densely, its cells are counted in place
with ``bincount``; the pairs of sparse tiles, and those of symbols beyond the ranks, are counted as sorted coordinates.
Counts of a tile meet in one task. The frequent pairs are then ranked in turn and paired with the next word, which
gives phrases of three words, and so on.

Ranked symbols are a table of bounded size; symbols beyond it are named by their 64-bit hash. A bitmap of bounded size
over the hashes of frequent symbols keeps most pairs that cannot be frequent from being counted at all; it decides
nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import blocks, column, ship, stored
from rasterloom.llm.hashing import Hashes, chained

WORDS, SUPPORT, SHARE, TOP, NO_LANG = 3, 10, 50, 2000, "und"
#: Symbols that are ranked, as a power of two, and those of a tile's side.
RANKS_LOG, SIDE_LOG = 18, 9
#: Bits of the bitmap over frequent symbols, as a power of two.
BITMAP_LOG = 26
#: A tile is dense in a block if it holds a pair for every so many cells.
CELLS_A_PAIR = 16
#: Counted pairs that a task merges, at 12 to 20 bytes each.
MERGED = 1 << 21
# What ends a piece, what separates words, and the letters that lose their case.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in _ENDS else 32 if b == 9 else b for b in range(256))
_SIGN, _MASK = np.uint64(1 << 63), np.uint64((1 << 63) - 1)
#: What can't be frequent.
_NONE = np.int64((1 << 62) - 1)


def pieces(text: bytes) -> list[bytes]:
    """The words of a text in their order; a line break word stands wherever a piece ends."""
    return text.translate(_BYTES).replace(b"\n", b" \n ").split(b" ")


class _Symbols:
    """Words of a language as 63-bit hashes; 0 for the end of a piece. One word has another hash in each language."""

    def __init__(self):
        self.hashes = {}

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        if lang not in self.hashes:
            if len(self.hashes) >= 16:
                self.hashes.clear()
            self.hashes[lang] = Hashes(xxhash.xxh64_intdigest(lang.encode()), {b"\n": 0})
        return self.hashes[lang].of(words) & _MASK


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, symbols) of the texts of each block and language, ends of pieces included."""
    symbols = _Symbols()
    for block in blocks(batches):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(block.column("lang").to_pylist(), block.column("text").to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text.encode())
        for lang, own in texts.items():
            words = [w for w in pieces(b"\n".join(own)) if w]
            if words:
                yield lang, words, symbols.of(lang, words)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, symbols in _by_lang(batches):
        found, first, n = np.unique(symbols, return_index=True, return_counts=True)
        if found[0] == 0:
            found, first, n = found[1:], first[1:], n[1:]
        for low in range(0, len(found), 1 << 16):
            cut = slice(low, low + (1 << 16))
            own = pa.array([words[i].decode() for i in first[cut].tolist()], pa.string())
            yield pa.record_batch([pa.array([lang] * len(own), pa.string()), own, pa.array(found[cut].view(np.int64)), pa.array(n[cut])], names=["lang", "word", "symbol", "n"])


class Ranked:
    """Frequent symbols: the hashes by rank, for search, and a bitmap over those beyond the ranks."""

    def __init__(self, symbols: np.ndarray, bitmap: np.ndarray | None):
        self.by_rank, self.bitmap = symbols, bitmap
        self.order = np.argsort(symbols).astype(np.int64)
        self.sorted = symbols[self.order]

    def ids(self, symbols: np.ndarray) -> np.ndarray:
        """The rank of each symbol; beyond the ranks its hash, as a negative number; ``_NONE`` if it can't be frequent."""
        ids = np.full(len(symbols), _NONE)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, symbols), len(self.sorted) - 1)
            ranked = self.sorted[at] == symbols
            ids[ranked] = self.order[at[ranked]]
        if self.bitmap is not None:
            rest = np.flatnonzero((ids == _NONE) & (symbols != 0))
            bit = symbols[rest] & np.uint64(64 * len(self.bitmap) - 1)
            rest = rest[(self.bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
            ids[rest] = (symbols[rest] | _SIGN).view(np.int64)
        return ids

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        """The hashes of ids."""
        found = ids.view(np.uint64) & _MASK
        ranked = ids >= 0
        found[ranked] = self.by_rank[ids[ranked]]
        return found


def _phrase(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return chained(first, word) & _MASK


def _ranked(frequent: DataFrame, ranks_log: int) -> tuple[Ranked, DataFrame]:
    """Ranks for a table of frequent symbols (symbol, n), and the table with its ids (``id``).

    At most 2 ** ``ranks_log`` symbols are collected, all those above a count; ties of the last count are not ranked.
    """
    spark = frequent.sparkSession
    grade = F.floor(32 * F.log2("n")).cast("int")
    held, least = 0, None
    for r in sorted(frequent.groupBy(grade.alias("g")).count().collect(), reverse=True):  # a few hundred rows at most
        held += r["count"]
        if held > 1 << ranks_log:
            break
        least = r["g"]
    top = frequent.where(grade >= least if least is not None else F.lit(False)).select("symbol", "n").toArrow()
    symbol, n = (top.column(c).to_numpy() for c in ("symbol", "n"))
    symbol = symbol[np.lexsort((symbol, -n))]
    bitmap = None
    rest = frequent.where(grade < least) if least is not None else frequent
    bit = F.col("symbol").bitwiseAND(F.lit((1 << BITMAP_LOG) - 1))
    word = F.shiftright(bit, 6).alias("word")
    # At most 2 ** (BITMAP_LOG - 6) rows.
    bits = rest.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(symbol & 63 AS INT))")).alias("bits")).toArrow()
    if bits.num_rows:
        bitmap = np.zeros(1 << (BITMAP_LOG - 6), np.uint64)
        bitmap[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    ranks = spark.createDataFrame(pa.table({"symbol": symbol.astype(np.int64), "rank": np.arange(len(symbol))}))
    ids = F.coalesce("rank", F.col("symbol").bitwiseOR(F.lit(-(1 << 63))))
    return Ranked(symbol.view(np.uint64), bitmap), frequent.join(F.broadcast(ranks), "symbol", "left").withColumn("id", ids).drop("rank")


def _count_pairs(shared, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of each block, cell by cell in dense tiles, as sorted coordinates elsewhere, by part."""
    words, phrases, sizes = shared.value
    for _, _, symbols in _by_lang(batches):
        last = words.ids(symbols)
        first, firsts = last, symbols
        for level in phrases:  # from words to the frequent phrases that start at each place
            known = (first[:-1] != _NONE) & (last[len(last) - len(first) + 1 :] != _NONE)
            firsts = np.where(known, _phrase(firsts[:-1], symbols[len(symbols) - len(firsts) + 1 :]), np.uint64(0))
            first = level.ids(firsts)
        # A phrase can be frequent only if the phrases without its first and without its last word are.
        a, b = first[:-1], last[len(last) - len(first) + 1 :]
        keep = (a != _NONE) & (b != _NONE) & (first[1:] != _NONE)
        a, b = a[keep], b[keep]
        both = (a >= 0) & (b >= 0)
        yield from _packed(True, parts, *_tiled(a[both], b[both], *sizes))
        yield from _packed(False, parts, *_coordinates(a[~both], b[~both]))


def _tiled(a: np.ndarray, b: np.ndarray, ranks_log: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """(cells, counts) of pairs of ranks; a cell is its tile's number followed by its place in the tile."""
    low, cells_log = (1 << side) - 1, 2 * side
    tile = (a >> side) << max(ranks_log - side, 0) | (b >> side)
    cell = tile << cells_log | (a & low) << side | (b & low)
    tiles, at, n = np.unique(tile, return_inverse=True, return_counts=True)
    dense = n * CELLS_A_PAIR >= 1 << cells_log
    cells, counts = [], []
    for t in np.flatnonzero(dense):
        own = np.bincount(cell[at == t] & ((1 << cells_log) - 1), minlength=1 << cells_log)
        held = np.flatnonzero(own)
        cells.append(tiles[t] << cells_log | held)
        counts.append(own[held])
    rest, n = np.unique(cell[~dense[at]], return_counts=True)
    return np.concatenate([*cells, rest]), np.concatenate([*counts, n])


def _coordinates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, counts) of pairs in the order of their coordinates."""
    order = np.lexsort((b, a))
    keys, n = _runs(np.stack([a[order], b[order]]), np.ones(len(a), np.int64))
    return keys[0], keys[1], n


def _runs(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted columns of ``keys``, each once, with the sums of ``n``."""
    if not len(n):
        return keys, n
    heads = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
    return keys[:, heads], np.add.reduceat(n, heads)


def _packed(tiled: bool, parts: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (part, tiled, keys, counts); equal cells and equal pairs go to the same part.

    A block sends each of them once, so that a part gets no more of a common pair than there are blocks.
    """
    *keys, n = arrays
    if not len(n):
        return
    part = (chained(*(np.ascontiguousarray(k).view(np.uint64) for k in (*keys, keys[0]))) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    heads = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
    for x, y in pairwise(heads.tolist()):
        own = order[x:y]
        held = np.stack([k[own] for k in keys]).tobytes()
        columns = [[int(part[own[0]])], [tiled], [held], [n[own].astype(np.int32).tobytes()]]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["part", "tiled", "keys", "counts"])


def _merging(support: int, shared):
    return lambda part: _merge(support, shared, part)


def _merge(support: int, shared, part: pa.Table) -> pa.Table:
    """The frequent pairs of one part: (a, b, symbol of the phrase, n)."""
    words, phrases, (ranks_log, side) = shared.value
    low, found = (1 << side) - 1, []
    for tiled in (True, False):
        own = part.filter(pa.compute.equal(part.column("tiled"), tiled))
        n = np.frombuffer(b"".join(own.column("counts").to_pylist()), np.int32).astype(np.int64)
        keys = [np.frombuffer(k, np.int64).reshape(1 if tiled else 2, -1) for k in own.column("keys").to_pylist()]
        if not keys:
            continue
        keys = np.concatenate(keys, axis=1)
        order = np.lexsort(keys[::-1])
        keys, n = _runs(keys[:, order], n[order])
        keys, n = keys[:, n >= support], n[n >= support]
        if tiled:
            tile = keys[0] >> (2 * side)
            a = (tile >> max(ranks_log - side, 0)) << side | (keys[0] >> side) & low
            b = (tile & ((1 << max(ranks_log - side, 0)) - 1)) << side | keys[0] & low
            keys = np.stack([a, b])
        found.append((*keys, n))
    a, b, n = (np.concatenate(c) for c in zip(*found, strict=True))
    symbol = _phrase((phrases[-1] if phrases else words).symbols(a), words.symbols(b))
    return pa.table({"a": a, "b": b, "symbol": symbol.view(np.int64), "n": n})


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = WORDS, support: int = SUPPORT,
                 share: int = SHARE, top: int = TOP, ranks_log: int = RANKS_LOG, side_log: int = SIDE_LOG) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``words`` words of each language.

    ``a`` counts the phrase, at least ``support``, ``l`` and ``r`` its parts at the cut with the lowest score
    floor(1000000 a a / (l r)), ``n`` all words of the language. A phrase goes if a longer one that holds it has ``share``
    hundredths of its count. Null texts count as empty, null languages as ``und``; repeated rows count each time. Equal
    scores rank by count, then by phrase. Without frequent phrases no rows. Only the named columns are read. Words are
    told apart by 63 bits of hash.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(column(lang_col), F.lit(NO_LANG)).alias("lang"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    counts = rows.mapInArrow(_count_words, "lang string, word string, symbol long, n long")
    counts = stored(counts.groupBy("lang", "word", "symbol").agg(F.sum("n").alias("n")), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    parts = -(-(counts.agg(F.sum("n")).first()[0] or 1) // MERGED)
    known, frequent = _ranked(stored(counts.where(F.col("n") >= support), "words"), ranks_log)
    frequent = frequent.select("id", "n", "lang", F.col("word").alias("text"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"),
                               F.lit(None).cast("long").alias("tail"), *(F.array().cast("array<long>").alias(c) for c in ("heads", "tails")))
    levels, phrases = [stored(frequent, "words")], []
    for k in range(2, words + 1):
        shared = spark.sparkContext.broadcast((known, phrases, (ranks_log, side_log)))  # at most 2 ** ranks_log symbols a level
        pairs = rows.mapInArrow(partial(_count_pairs, shared, parts), "part long, tiled boolean, keys binary, counts binary")
        pairs = pairs.groupBy("part").applyInArrow(_merging(support, shared), "a long, b long, symbol long, n long")
        level, pairs = _ranked(stored(pairs, f"phrases-{k}"), ranks_log)
        phrases = [*phrases, level]
        levels.append(stored(_described(pairs, levels, k), f"phrases-{k}"))
    found = [_scored(own, longer, share) for own, longer in zip(levels[1:], [*levels[2:], None], strict=True)]
    best = found[0]
    for own in found[1:]:
        best = best.unionByName(own)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def _described(pairs: DataFrame, levels: list[DataFrame], k: int) -> DataFrame:
    """Phrases of ``k`` words with their text, the counts of their first 1 to k - 1 words (``heads``) and of what
    follows (``tails``), and the id of the phrase without its first word (``tail``)."""
    first = levels[-1].select(F.col("id").alias("a"), "lang", F.col("text").alias("start"), F.col("tail").alias("inner"), F.array_append("heads", F.col("n")).alias("heads"))
    word = levels[0].select(F.col("id").alias("b"), F.col("text").alias("word"))
    rest = levels[-1].select(F.col("id").alias("tail"), F.col("a").alias("inner"), "b", F.array_prepend("tails", F.col("n")).alias("tails"))
    rows = pairs.select("id", "n", "a", "b").join(first, "a").join(word, "b")
    rows = rows.join(rest.drop("inner", "b").withColumn("b", F.col("tail")), "b") if k == 2 else rows.join(rest, ["inner", "b"])
    return rows.select("id", "n", "lang", F.concat_ws(" ", "start", "word").alias("text"), "a", "b", "tail", "heads", "tails")


def _scored(phrases: DataFrame, longer: DataFrame | None, share: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one stands for."""
    if longer is not None:
        held = longer.select(F.col("a").alias("id"), "n").unionAll(longer.select("tail", "n"))
        phrases = phrases.join(held.groupBy("id").agg(F.max("n").alias("most")), "id", "left")
        phrases = phrases.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("n")))
    # Products of two counts times a million stay below 38 digits, and the quotient is at most a million.
    score = "(1000000 * (cast(n AS DECIMAL(16)) * cast(n AS DECIMAL(16)))) div (cast(c.heads AS DECIMAL(16)) * cast(c.tails AS DECIMAL(16)))"
    cuts = F.expr(f"transform(arrays_zip(heads, tails), (c, i) -> struct({score} AS score, i AS cut, c.heads AS l, c.tails AS r))")
    phrases = phrases.withColumn("best", F.array_min(cuts))
    return phrases.select("lang", F.col("text").alias("phrase"), F.col("n").alias("a"), "best.l", "best.r", "best.score")
