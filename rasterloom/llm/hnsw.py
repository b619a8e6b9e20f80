"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard, shard results merged.

Equal vectors are one point of the index; the ids that share it are put back after the search, so copies neither fill
neighbour lists nor hide each other. Each shard of bounded size is a hierarchy of graphs, kept as flat neighbour
arrays. Vectors of one shard are of like length, within a factor of four, and are scaled by a power of two, so neither
very long nor very short ones take digits from others. Within a shard one more coordinate makes all vectors equally
long, so that near by inner product is near in space. Points enter in batches that are searched and linked together.
The index is a written table; queries come to the shards in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import column, ship, stored

SHARD = 8192
LINKS, WIDTH, SEARCH_WIDTH = 16, 64, 128
BLOCK = 1024
_BATCH, _EXPAND = 512, 4


def search_layer(points, graph, queries, starts, width):
    """The ``width`` best points found for each query, best first: (places, likeness); -1 where there are none."""
    n = len(queries)
    ids = np.full((n, width), -1, np.int64)
    like = np.full((n, width), -np.inf, np.float32)
    open_ = np.zeros((n, width), bool)
    seen = np.zeros((n, len(points) + 1), bool)  # the last column stands for -1
    seen[:, -1] = True
    rows, new = np.arange(n), starts
    while len(rows):
        new = np.sort(new, axis=1)
        twice = np.zeros(new.shape, bool)
        twice[:, 1:] = new[:, 1:] == new[:, :-1]
        new = np.where(twice | seen[rows[:, None], new], -1, new)
        seen[rows[:, None], new] = True
        score = np.matmul(points[new], queries[rows][:, :, None])[:, :, 0]
        score = np.where(new >= 0, score, np.float32(-np.inf))
        all_ids = np.concatenate((ids[rows], new), axis=1)
        all_like = np.concatenate((like[rows], score), axis=1)
        all_open = np.concatenate((open_[rows], new >= 0), axis=1)
        order = np.argsort(-all_like, axis=1, kind="stable")[:, :width]
        ids[rows] = np.take_along_axis(all_ids, order, 1)
        like[rows] = np.take_along_axis(all_like, order, 1)
        open_[rows] = np.take_along_axis(all_open, order, 1)
        rows = rows[open_[rows].any(axis=1)]
        if not len(rows):
            break
        pick = np.argsort(~open_[rows], axis=1, kind="stable")[:, :_EXPAND]
        valid = np.take_along_axis(open_[rows], pick, 1)
        at = np.where(valid, np.take_along_axis(ids[rows], pick, 1), -1)
        state = open_[rows]
        np.put_along_axis(state, pick, False, 1)
        open_[rows] = state
        new = np.where((at >= 0)[:, :, None], graph[at], -1).reshape(len(rows), -1)
    return ids, like


def select(points, candidates, like, most):
    """For each row of candidates, best first, at most ``most`` that are nearer to the row's point than to each other."""
    n, wide = candidates.shape
    vectors = points[candidates]
    mutual = np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen, spare = np.zeros((n, wide), bool), candidates >= 0
    blocked = ~spare
    for i in range(wide):
        take = ~blocked[:, i] & (chosen.sum(axis=1) < most)
        chosen[:, i] = take
        # What is nearer to the one just taken than to the point is reached through it.
        blocked |= take[:, None] & (mutual[:, i, :] > like)
    rank = np.where(chosen, np.arange(wide), np.where(spare, wide + np.arange(wide), 3 * wide))  # then fill up
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(rank, order, 1) < 3 * wide, np.take_along_axis(candidates, order, 1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def scaled(vectors: np.ndarray, axis: int | None = None) -> np.ndarray:
    """The vectors times a power of two, one for all or one a row, so that the largest component is from 0.5 to 1."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=axis, keepdims=True, initial=0))
    return np.ldexp(vectors, -exponent)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """The vectors, scaled, with one more coordinate that makes all of them equally long."""
    vectors = scaled(vectors)
    norms = (vectors * vectors).sum(axis=1)
    rest = np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))
    out = np.concatenate((vectors, rest[:, None]), axis=1)
    return (out / max(np.sqrt(norms.max(initial=0)), 1e-300)).astype(np.float32)


def build(vectors: np.ndarray, links: int = LINKS, width: int = WIDTH, seed: int = 5) -> tuple[np.ndarray, list[np.ndarray]]:
    """Levels of the points, and for each level a flat array of neighbours, -1 where there are none; a row a point."""
    points = lifted(vectors)
    n = len(points)
    drawn = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - drawn.random(n)) / math.log(links)).astype(int), 6)
    graphs = [np.full((n, 2 * links if level == 0 else links), -1, np.int64) for level in range(levels.max(initial=0) + 1)]
    entry = [-1] * len(graphs)
    order, done = drawn.permutation(n), 0
    while done < n:
        batch = order[done : done + max(32, min(done, _BATCH))]
        starts = np.full((len(batch), 1), -1, np.int64)
        for level in range(len(graphs) - 1, -1, -1):
            graph = graphs[level]
            if entry[level] >= 0:
                first = np.where(starts[:, :1] < 0, entry[level], starts)
                starts, like = search_layer(points, graph, points[batch], first, width)
            else:
                like = np.full(starts.shape, -np.inf, np.float32)
            own = np.flatnonzero(levels[batch] >= level)
            if len(own):
                _link(points, graph, batch[own], starts[own], like[own])
                if entry[level] < 0:
                    entry[level] = int(batch[own[0]])
        done += len(batch)
    return levels, graphs


def _link(points, graph, batch, found, like) -> None:
    """Links new points with what was found for them and with each other."""
    wide = graph.shape[1]
    mutual = points[batch] @ points[batch].T
    np.fill_diagonal(mutual, -np.inf)
    k = min(len(batch) - 1, wide)
    near = np.argsort(-mutual, axis=1, kind="stable")[:, :k]
    ids = np.concatenate((found, batch[near]), axis=1)
    like = np.concatenate((like, np.take_along_axis(mutual, near, 1)), axis=1)
    order = np.argsort(-like, axis=1, kind="stable")[:, : 2 * wide]
    ids, like = np.take_along_axis(ids, order, 1), np.take_along_axis(like, order, 1)
    if not ids.shape[1]:
        return
    graph[batch] = chosen = select(points, ids, like, wide)
    a, b = np.repeat(batch, wide), chosen.ravel()
    a, b = a[b >= 0], b[b >= 0]
    fresh = ~(graph[b] == a[:, None]).any(axis=1)
    a, b = a[fresh], b[fresh]
    if not len(a):
        return
    score = (points[a] * points[b]).sum(axis=1)
    order = np.lexsort((-score, b))
    a, b = a[order], b[order]
    heads = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    nth = np.arange(len(b)) - np.repeat(heads, np.diff(np.append(heads, len(b))))
    target = b[heads]
    row = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(b))))
    incoming = np.full((len(target), wide), -1, np.int64)
    keep = nth < wide
    incoming[row[keep], nth[keep]] = a[keep]
    ids = np.concatenate((graph[target], incoming), axis=1)
    like = np.matmul(points[ids], points[target][:, :, None])[:, :, 0]
    like = np.where(ids >= 0, like, np.float32(-np.inf))
    order = np.argsort(-like, axis=1, kind="stable")
    ids, like = np.take_along_axis(ids, order, 1), np.take_along_axis(like, order, 1)
    full = (ids >= 0).sum(axis=1) > wide
    graph[target[~full]] = ids[~full][:, :wide]
    for low in range(0, int(full.sum()), _BATCH):
        cut = np.flatnonzero(full)[low : low + _BATCH]
        graph[target[cut]] = select(points, ids[cut], like[cut], wide)


def search(vectors, levels, graphs, queries, k, width=SEARCH_WIDTH):
    """(places, scores) of the ``k`` best points found for each query; scores in double precision, -inf where none."""
    points = lifted(vectors)
    unit = scaled(queries, axis=1)
    unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    asked = np.concatenate((unit, np.zeros((len(queries), 1))), axis=1).astype(np.float32)
    top = len(graphs) - 1
    starts = np.full((len(queries), 1), int(np.flatnonzero(levels >= top)[0]), np.int64)
    for level in range(top, -1, -1):
        starts, _ = search_layer(points, graphs[level], asked, starts, width if level == 0 else 8)
    with np.errstate(over="ignore", invalid="ignore"):  # a product may pass the range of a double
        scores = np.where(starts >= 0, (vectors[starts] * queries[:, None, :]).sum(axis=2), -np.inf)
    order = np.lexsort((starts, -scores, starts < 0), axis=1)[:, :k]
    return np.take_along_axis(starts, order, 1), np.take_along_axis(scores, order, 1)


def _packed(rows: np.ndarray, levels: np.ndarray, graphs: list[np.ndarray]) -> tuple[bytes, bytes, bytes]:
    flat = [g[levels >= level].astype("<i4").ravel() for level, g in enumerate(graphs)]
    return rows.astype("<f8").tobytes(), levels.astype("<i4").tobytes(), np.concatenate(flat).tobytes()


def _unpacked(dim: int, rows: bytes, levels: bytes, neighbours: bytes, links: int):
    vectors = np.frombuffer(rows, "<f8").reshape(-1, dim)
    levels, flat, graphs, at = np.frombuffer(levels, "<i4"), np.frombuffer(neighbours, "<i4"), [], 0
    for level in range(levels.max() + 1):
        own, wide = np.flatnonzero(levels >= level), 2 * links if level == 0 else links
        graph = np.full((len(levels), wide), -1, np.int64)
        graph[own] = flat[at : at + len(own) * wide].reshape(-1, wide)
        graphs.append(graph)
        at += len(own) * wide
    return vectors, levels, graphs


def band(v: Column) -> Column:
    """The length band of a vector of finite numbers, not all zero: each holds lengths up to four times its least."""
    v = v.cast("array<double>")
    largest = F.array_max(F.transform(v, F.abs))
    rest = F.aggregate(F.transform(v, lambda x: x / largest), F.lit(0.0), lambda total, x: total + x * x)
    return F.floor((F.log2(largest) + F.log2(rest) / 2 + 1) / 2)


_INDEX = "shard long, dim int, ids binary, vectors binary, levels binary, neighbours binary"


def index(points: DataFrame, shard: int = SHARD, links: int = LINKS, width: int = WIDTH) -> DataFrame:
    """A row (shard, dim, ids, vectors, levels, neighbours) for each shard of points (id, dim, v).

    Shards hold about ``shard`` points of one dimension and length band, dealt by a hash of the id.
    """
    ship(points.sparkSession)
    points = points.withColumn("band", band(F.col("v")))
    sizes = points.groupBy("dim", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / shard), F.lit(1)).alias("shards"))
    rows = points.join(sizes, ["dim", "band"])  # about 1,100 bands a dimension at most
    rows = rows.select(F.xxhash64("dim", "band", F.pmod(F.xxhash64("id"), F.col("shards"))).alias("shard"), "dim", "id", "v")
    rows = rows.repartition("shard").sortWithinPartitions("shard", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, part in _runs(batches):
            ids = part.column("id").to_numpy()
            dim = part.column("dim")[0].as_py()
            vectors = np.array(part.column("v").combine_chunks().flatten().to_numpy(), np.float64).reshape(-1, dim)
            levels, graphs = build(vectors, links, width)
            rows, marks, flat = _packed(vectors, levels, graphs)
            values = [key, dim, ids.astype("<i8").tobytes(), rows, marks, flat]
            yield pa.record_batch(
                [pa.array([x], t) for x, t in zip(values, [pa.int64(), pa.int32()] + 4 * [pa.binary()], strict=True)],
                names=["shard", "dim", "ids", "vectors", "levels", "neighbours"],
            )

    return stored(rows.mapInArrow(run, _INDEX), "graph-index")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard, from rows sorted by shard; a shard is of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if held and held[0].column(0)[0].as_py() != shards[low]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def candidates(built: DataFrame, queries: DataFrame, k: int, links: int = LINKS, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query, id, score): the ``k`` best points of each shard for each query (id, dim, v).

    Queries travel in blocks; each block goes to every shard of its dimension.
    """
    ship(queries.sparkSession)
    sized = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-queries.count() // BLOCK)))))
    packed = sized.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows"))  # of bounded size
    shards = built.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    asked = packed.join(shards, "dim").select(F.explode("shards").alias("shard"), "dim", "block", "rows")
    none = F.lit(None)
    index_rows = built.select(
        "shard", "dim", F.lit(-1).cast("long").alias("block"), none.cast(packed.schema["rows"].dataType).alias("rows"),
        "ids", "vectors", "levels", "neighbours",
    )
    asked = asked.select(
        "shard", "dim", "block", "rows", *(none.cast("binary").alias(c) for c in ("ids", "vectors", "levels", "neighbours"))
    )
    rows = index_rows.unionAll(asked).repartition("shard").sortWithinPartitions("shard", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                dim = row["dim"].as_py()
                if row["block"].as_py() < 0:
                    ids = np.frombuffer(row["ids"].as_py(), "<i8")
                    own = _unpacked(dim, *(row[c].as_py() for c in ("vectors", "levels", "neighbours")), links)
                    continue
                block = row["rows"].values
                asked_ids = block.field("id").to_numpy()
                vectors = np.array(block.field("v").flatten().to_numpy(), np.float64).reshape(-1, dim)
                for low in range(0, len(vectors), _BATCH):
                    cut = slice(low, low + _BATCH)
                    places, scores = search(*own, vectors[cut], k, width)
                    good = places.ravel() >= 0
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(asked_ids[cut], places.shape[1])[good]),
                            pa.array(ids[places.ravel()[good]]),
                            pa.array(scores.ravel()[good]),
                        ],
                        names=["query", "id", "score"],
                    )

    return rows.mapInArrow(run, "query long, id long, score double")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            shard: int = SHARD, links: int = LINKS, width: int = WIDTH, search_width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best rows found for each row whose id is divisible by ``every``.

    The score is the inner product in double precision; ties go to the smaller id; a row is not its own neighbour.
    Rows without an id, and vectors that are null, empty, zero or hold null or non-finite components, take no part.
    Rows that share id and vector count once. Vectors of different lengths are not compared. Other columns are not
    read. An empty table gives no rows. Finite vectors of any length take part; products beyond the range of a double
    are infinite, and sums of opposite infinite ones, not numbers, come last.
    """
    v = column(vector_col)
    real = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(column(id_col).isNotNull() & real)
    rows = rows.select(column(id_col).cast("long").alias("id"), F.size(v).alias("dim"), v.alias("v"))
    # A result names at most k ids and the query's own may be among the first: of equal vectors k + 1 ids suffice.
    same = Window.partitionBy("v").orderBy("id")
    first = rows.withColumn("nth", F.dense_rank().over(same)).where(F.col("nth") <= k + 1)
    first = first.groupBy("v", "dim", "id").agg(F.min("nth").alias("nth"))
    members = stored(first.withColumn("point", F.min("id").over(Window.partitionBy("v"))), "vectors")
    points = members.where("nth = 1").select("id", "dim", "v")
    asked = rows.where(F.col("id") % every == 0).distinct()
    asked = asked.join(points.select("v", F.col("id").alias("point")), "v").select("id", "point")
    asked = stored(asked, "queries")
    wanted = points.join(asked.select(F.col("point").alias("id")).distinct(), "id", "left_semi")
    found = candidates(index(points, shard, links, width), wanted, k + 1, links, search_width)
    # Spark takes what is not a number for the largest one.
    order = F.isnan("score"), F.desc("score")
    best = Window.partitionBy("query").orderBy(*order, "id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    found = found.select("query", F.col("id").alias("point"), "score")
    spread = found.join(members.select("point", "id"), "point")
    spread = spread.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    spread = spread.select(F.col("query").alias("point"), F.col("id").alias("near"), "score")
    out = asked.join(spread, "point").where("near != id")
    own = Window.partitionBy("id").orderBy(*order, "near")
    out = out.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select(F.col("id").alias("query_id"), "rank", F.col("near").alias(id_col), "score")
