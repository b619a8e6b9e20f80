"""Joins and ranks that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.session import stored

# A key is hot if it holds more rows than an average shuffle partition, so there are fewer hot keys than
# shuffle partitions. The sketch tracks a multiple of that, at least so many keys.
TRACKED_KEYS = 4096
_MOST_TRACKED = 1_000_000


def hot_keys(df: DataFrame, key: str) -> dict[str, tuple[int, int]]:
    """(rows, salts) per hot key; salts are the average shuffle partitions its rows would fill.

    One pass over the key column with a sketch of fixed size per task; its error, about one row
    in a thousand, lies well below the share that makes a key hot. The answer steers how rows are
    spread, never the result.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(_MOST_TRACKED, max(TRACKED_KEYS, 16 * width))
    top = F.expr(f"approx_top_k(cast(`{key}` AS STRING), {min(width, tracked)}, {tracked})")
    found, total = df.agg(top, F.count(key)).first()
    return {
        k: (n, min(n, -(-n * width // total)))
        for k, n in found
        if k is not None and n * width > total
    }


def _salted(df: DataFrame, key: str, hot: dict[str, tuple[int, int]], name: str, salt) -> DataFrame:
    """Add ``name``: ``salt`` of the key's number of salts, 0 if none is hot.

    The hot keys are a table of fewer rows than there are shuffle partitions, joined by broadcast.
    """
    if not hot:
        return df.withColumn(name, F.lit(0).cast("long"))
    table = df.sparkSession.createDataFrame(
        [(k, salts) for k, (_, salts) in hot.items()], "_hot_key string, _hot_salts long"
    )
    known = df.join(F.broadcast(table), F.col(key).cast("string") == F.col("_hot_key"), "left")
    return known.withColumn(name, salt(F.coalesce("_hot_salts", F.lit(1)))).drop("_hot_key", "_hot_salts")


def _scattered(df: DataFrame, key: str, hot, name: str, spread_by: Sequence[str]) -> DataFrame:
    return _salted(df, key, hot, name, lambda n: F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), n))


def _copied(df: DataFrame, key: str, hot, name: str) -> DataFrame:
    return _salted(df, key, hot, name, lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Join ``rows`` with a ``lookup`` that is unique on ``key``.

    Rows of hot keys are scattered over salts by ``spread_by``; the few lookup rows they need are
    copied to each salt. Joins with a computed lookup are outside the adaptive skew rule, hence
    this. ``hot`` saves the search when it was made on a cheaper table.
    """
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return rows.join(lookup, key, how)
    left = _scattered(rows, key, hot, "_salt", spread_by)
    right = _copied(lookup, key, hot, "_salt")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def inner_pairs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: Sequence[str],
    right_id: Sequence[str],
    hot_left: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Inner join with multiplicity; keys hot on either side are split over many tasks.

    Of a key hot on both sides the larger side is scattered and the other copied. A key gets no more salts
    than it has rows on the scattered side, so the copies never outnumber the joined rows.
    """
    hot_left = hot_keys(left, key) if hot_left is None else hot_left
    hot_right = hot_keys(right, key)
    by_left = {k: v for k, v in hot_left.items() if v[0] >= hot_right.get(k, (0, 0))[0]}
    by_right = {k: v for k, v in hot_right.items() if k not in by_left}
    if not by_left and not by_right:
        return left.join(right, key)
    a = _copied(_scattered(left, key, by_left, "_s", left_id), key, by_right, "_c")
    b = _copied(_scattered(right, key, by_right, "_c", right_id), key, by_left, "_s")
    return a.join(b, [key, "_s", "_c"]).drop("_s", "_c")


def first_per(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row of each key; the planner limits each group to one row before the shuffle."""
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def with_position(
    df: DataFrame, order: Sequence[Column], blocks: tuple[Column, Column] | None = None
) -> DataFrame:
    """Add ``position``: 0-based rank in list order, without a window over the whole table.

    ``blocks`` are (coarse, fine) expressions that rise with the order and bound the rows per
    (coarse, fine) block. The default cuts a unique long ordinal into blocks of 65,536 values, and the
    ordinal of a scanned CSV by file and block.
    """
    return _placed(df, order, blocks).drop("_total")


def _placed(df: DataFrame, order: Sequence[Column], blocks) -> DataFrame:
    """``position`` and ``_total``: rows are ranked per block, and counts of blocks are summed
    first within each coarse block, then over the coarse blocks."""
    table = stored(df, "positions")
    if blocks is None:
        first = order[0]
        if table.select(first).schema[0].dataType.typeName() == "struct":
            blocks = (first["file"], F.struct(first["block"], F.shiftright(first["row"], 16)))
        else:
            blocks = (F.shiftright(first, 32), F.shiftright(first, 16))
    cut = table.withColumn("_coarse", blocks[0]).withColumn("_fine", blocks[1])
    counts = cut.groupBy("_coarse", "_fine").agg(F.count("*").alias("_n"))
    within = Window.partitionBy("_coarse").orderBy("_fine")
    fine = counts.withColumn("_before", F.sum("_n").over(within) - F.col("_n"))
    totals = counts.groupBy("_coarse").agg(F.sum("_n").alias("_n"))
    so_far = F.sum("_n").over(Window.orderBy("_coarse"))
    everything = F.sum("_n").over(Window.partitionBy())
    coarse = totals.select(
        "_coarse", (so_far - F.col("_n")).alias("_base"), everything.alias("_total")
    )
    offsets = fine.join(coarse, "_coarse").drop("_n")
    rank = F.row_number().over(Window.partitionBy("_coarse", "_fine").orderBy(*order))
    ranked = cut.withColumn("_rank", rank)
    return (
        ranked.join(offsets, ["_coarse", "_fine"])
        .withColumn("position", F.col("_base") + F.col("_before") + F.col("_rank") - 1)
        .drop("_coarse", "_fine", "_base", "_before", "_rank")
    )


def chunk_plan(
    df: DataFrame,
    chunks: int,
    order: Sequence[Column],
    blocks: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Add ``chunk``: near-equal contiguous split of the list, ceil(n / chunks) rows each."""
    if chunks < 1:
        raise ValueError("chunks must be positive")
    size = F.ceil(F.col("_total") / F.lit(chunks))
    placed = _placed(df, order, blocks)
    return placed.withColumn("chunk", F.floor(F.col("position") / size)).drop("_total")


def cap(df: DataFrame, max_samples: int | None, order: Sequence[Column]) -> DataFrame:
    """First ``max_samples`` rows in list order; None and 0 mean all."""
    if not max_samples:
        return df
    if max_samples < 0:
        raise ValueError("max_samples must not be negative")
    return df.orderBy(*order).limit(max_samples)
