"""SimHash near-duplicates with a hierarchical index in Gray order.

Distinct fingerprints meet in the groups of their segments: of five segments, fingerprints that differ in four bits
or fewer share one at least. Within a task the fingerprints of each group lie in Gray order, so neighbours share
most bits. Runs of them become the leaves' parents, runs of those the next level: a node keeps the bits that all its
members share. Two nodes are compared by the bits both share: more differences than allowed prune all pairs below
them, and if even all other bits could not exceed the limit, the members are linked without going down. Groups that
are too large for a task are cut by five segments of their other bits in the same, exact way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.bpe import _arrow_type
from rasterloom.llm.common import blocks, column, emit, ship, stored
from rasterloom.llm.components import components

BITS, LIMIT, SHINGLE, SEED = 64, 4, 4, 42
#: Members of a node.
FAN = 8
#: A segment group of more fingerprints is cut once more.
GROUP = 1 << 17
#: Fingerprints that a task compares at a time, if no single group is larger.
BLOCK = 1 << 17
_PAIRS = 1 << 19
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: a bit is set if it is set in over half the hashes of its shingles; 0 without words."""
    words = text.encode().lower().split()  # of bytes: A-Z and the six ASCII white space characters only
    counts, n = np.zeros(BITS, np.int64), max(len(words) - shingle + 1, 1 if words else 0)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    joined = b" ".join(words)
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _CHUNK):
        cut = zip(starts[low : min(low + _CHUNK, n)].tolist(), ends[low : low + _CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cut], np.uint64)
        octets = hashes.view(np.uint8).reshape(-1, 8)
        place = np.bincount((octets + _PLACES).ravel(), minlength=2048).reshape(8, 256)
        counts += (place @ _OCTETS).ravel()
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


_PLACES = np.arange(8, dtype=np.int64) * 256
_OCTETS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp) of each row; fp as a signed 64-bit integer, key a hash of the text. A null text counts as empty."""
    ship(docs.sparkSession)
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    schema = pa.schema([("id", _arrow_type(rows)), ("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for block in blocks(batches):
                keys, texts = block.column("id").to_pylist(), block.column("text").to_pylist()
                for id_, key, text in zip(keys, block.column("key").to_pylist(), texts, strict=True):
                    fp = fingerprint(text, shingle)
                    yield 24, (id_, key, fp - (1 << 64) if fp >> 63 else fp)

        yield from emit(schema, each())

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key long, fp long")


def gray_rank(fp: Column) -> Column:
    """The place of a fingerprint in Gray order, as an unsigned number in a long."""
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, by))
    return fp


def _segments(low: int, high: int) -> list[tuple[int, int]]:
    """Bits low to high in one segment more than bits may differ: (first bit, number of bits)."""
    cuts = [low + (high - low) * i // (LIMIT + 1) for i in range(LIMIT + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _segment(fp: Column, first: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _rotated(fp: Column, by: int) -> Column:
    """The bits from ``by`` on first: the others follow at the top."""
    return fp if by == 0 else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, BITS - by))


def grouped(fps: DataFrame) -> DataFrame:
    """(part, fp): each distinct fingerprint in the groups where it meets all that may be near."""
    keys = [F.struct(F.lit(i).alias("s"), _segment(F.col("fp"), a, n).alias("v")) for i, (a, n) in enumerate(_segments(0, BITS))]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.s", "k.v")
    large = rows.groupBy("s", "v").count().where(F.col("count") > GROUP).select("s", "v", F.lit(True).alias("large"))
    rows = rows.join(large, ["s", "v"], "left")
    # Within a group the bits of its segment are equal; the others are cut again, the segment turned to the end.
    again = []
    for i, (a, n) in enumerate(_segments(0, BITS)):
        turned = _rotated(F.col("fp"), (a + n) % BITS)
        own = [_segment(turned, b, m).bitwiseOR(F.lit((j + 1) << 32).cast("long")) for j, (b, m) in enumerate(_segments(0, BITS - n))]
        again.append(F.when(F.col("s") == i, F.array(*own)))
    finer = F.when(F.col("large"), F.coalesce(*again)).otherwise(F.array(F.lit(0).cast("long")))
    rows = rows.select("fp", "s", "v", F.explode(finer).alias("w"))
    return rows.select(F.xxhash64("s", "v", "w").alias("part"), "s", "v", "w", "fp")


def links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column fp) that connect all that differ in ``limit`` bits or fewer.

    They connect the same fingerprints as all such pairs, but are at most one edge a fingerprint and group.
    """
    if limit != LIMIT:
        raise ValueError(f"the segments are made for {LIMIT} bits")
    ship(fps.sparkSession)
    rows = grouped(fps).withColumn("g", gray_rank(F.col("fp")))
    # As unsigned: the top bit first.
    rows = rows.repartition("part").sortWithinPartitions("part", "s", "v", "w", F.col("g") < 0, "g")
    rows = rows.select("part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, fp in _whole_groups(batches):
            a, b = near(part, fp.view(np.uint64), LIMIT)
            for low in range(0, len(a), 1 << 16):
                cut = slice(low, low + (1 << 16))
                yield pa.record_batch([pa.array(fp[a[cut]]), pa.array(fp[b[cut]])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole groups of rows sorted by group, several in a block."""
    parts, fps, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append(batch.column(0).to_numpy())
        fps.append(batch.column(1).to_numpy())
        size += batch.num_rows
        if size >= BLOCK:
            part, fp = np.concatenate(parts), np.concatenate(fps)
            change = np.flatnonzero(part != part[-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield part[:cut], fp[:cut]
            parts, fps, size = [part[cut:]], [fp[cut:]], len(part) - cut
    if size:
        yield np.concatenate(parts), np.concatenate(fps)


def near(part: np.ndarray, fp: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) that connect the fingerprints of each group that are near each other; Gray order within groups."""
    forest = Forest(len(fp))
    levels = [(fp, fp, np.arange(len(fp)), np.ones(len(fp), np.int64))]  # and, or, first child, number of children
    owner = part
    while True:
        new = np.concatenate(([True], owner[1:] != owner[:-1]))
        first = np.flatnonzero(new)
        if len(first) == len(owner):
            break
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        heads = np.flatnonzero(new | (place % FAN == 0))
        low, high = levels[-1][:2]
        sizes = np.diff(np.append(heads, len(owner)))
        levels.append((np.bitwise_and.reduceat(low, heads), np.bitwise_or.reduceat(high, heads), heads, sizes))
        owner = owner[heads]
    top = len(levels) - 1
    roots = np.arange(len(owner))
    stack = [(top, roots[i : i + _PAIRS], roots[i : i + _PAIRS]) for i in range(0, len(roots), _PAIRS)]
    firsts = [np.arange(len(fp))]  # the first fingerprint below each node
    for _, _, heads, _ in levels[1:]:
        firsts.append(firsts[-1][heads])
    while stack:
        level, a, b = stack.pop()
        low, high, child, sizes = levels[level]
        shared = ~(low[a] ^ high[a]) & ~(low[b] ^ high[b])
        least = np.bitwise_count((low[a] ^ low[b]) & shared)
        most = least + np.bitwise_count(~shared)
        sure = (most <= limit) & (least <= limit)
        across = sure & (a != b)
        forest.join(firsts[level][a[across]], firsts[level][b[across]])
        if level == 0:
            continue
        within = np.flatnonzero(sure & (a == b))
        if len(within):
            ends = np.append(firsts[level], len(fp))
            begin, end = ends[a[within]], ends[a[within] + 1]
            n = end - begin
            member = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            forest.join(member, np.repeat(begin, n))
        down = (least <= limit) & ~sure
        a, b = a[down], b[down]
        many = sizes[a] * sizes[b]
        cuts = np.searchsorted(np.cumsum(many), np.arange(_PAIRS, int(many.sum()) + _PAIRS, _PAIRS))
        for x, y in zip([0, *(cuts + 1)], [*(cuts + 1), len(a)], strict=True):
            x, y = min(x, len(a)), min(y, len(a))
            if x == y:
                continue
            own, n = slice(x, y), many[x:y]
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            width = np.repeat(sizes[b[own]], n)
            i = np.repeat(child[a[own]], n) + nth // width
            j = np.repeat(child[b[own]], n) + nth % width
            keep = i <= j if level > 1 else i < j
            stack.append((level - 1, i[keep], j[keep]))
    root = forest.roots()
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return moved, root[moved]


class Forest:
    """Connects places; each ends at the smallest place it is connected with."""

    def __init__(self, n: int):
        self.root, self.a, self.b, self.size = np.arange(n), [], [], 0

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.size += len(a)
            if self.size > 1 << 20:
                self.roots()

    def roots(self) -> np.ndarray:
        if self.size:
            a, b, root = np.concatenate(self.a), np.concatenate(self.b), self.root
            while True:
                x, y = root[a], root[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root[:] = root[root]
            self.a, self.b, self.size = [], [], 0
        return self.root


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp, component, first_key) of each row: the smallest id reachable over near fingerprints.

    Null and empty texts have fingerprint zero and are linked like any other. Rows without an id take part, but give
    no id; a group of such rows only has a null component. Repeated rows each get their result. ``first_key`` is the
    smallest text hash among the group's rows with the smallest id. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "key"))).alias("first"))
    nodes = stored(nodes, "fingerprints")
    roots = components(links(nodes.select("fp")))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("first").alias("least"))
    named = nodes.join(least, "root").select("fp", F.col("least.id").alias("component"), F.col("least.key").alias("first_key"))
    return rows.join(named, "fp").select("id", "key", "fp", "component", "first_key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint, component_id) of each row; the fingerprint as 16 hexadecimal digits."""
    return groups(docs, id_col, text_col, shingle).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, that with the smallest id, with all its columns. Rows without an id all stay."""
    found = groups(docs, id_col, text_col, shingle)
    first = found.where((F.col("id") == F.col("component")) & (F.col("key") == F.col("first_key")))
    first = first.select(F.col("id").alias("__first_id"), F.col("key").alias("__first_key")).distinct()
    own = F.xxhash64(F.coalesce(column(text_col), F.lit("")))
    same = (column(id_col) == F.col("__first_id")) & (own == F.col("__first_key"))
    kept = docs.join(first, same, "left_semi").withColumn("__key", own).dropDuplicates([id_col, "__key"]).drop("__key")
    return kept.unionByName(docs.where(column(id_col).isNull()))
