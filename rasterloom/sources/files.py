"""File inventories: (dir, name, size_bytes, mtime) rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.names import has_suffix
from rasterloom.session import qualified, ship, stored
from rasterloom.sources import storage

# Fixed value: order in which input folders are tried.
INPUT_FOLDERS = ("images", "samples", "Samples", ".")

INVENTORY_SCHEMA = "dir string, name string, size_bytes long, mtime timestamp, path string"
_LISTING_ROWS = 10_000


def list_files(
    spark: SparkSession,
    folders: Mapping[str, str],
    suffixes: Sequence[str] | None = None,
    recurse: bool = False,
    skip: Sequence[str] = (),
) -> DataFrame:
    """All plain files inside ``folders`` (label -> path), empty ones included.

    Each folder is listed by one task, which streams the entries of a mounted file system instead of holding them. With
    ``recurse`` the tree is walked level by level, the folders of a level over all tasks, and names are paths below the
    folder; folders whose path below it is in ``skip`` are not entered. Levels are kept in the shared folder, so a lost
    executor repeats its own folders only; the driver sees no names.
    """
    ship(spark)
    places = [(label, qualified(spark, path), "") for label, path in folders.items()]
    frontier = spark.createDataFrame(places, "dir string, uri string, below string").repartition(len(places) or 1)
    if not recurse:
        found = frontier.mapInArrow(_listing, f"{INVENTORY_SCHEMA}, folder boolean, uri string").where("not folder")
    else:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        levels = []
        while not levels or not frontier.isEmpty():
            level = frontier.mapInArrow(_listing, f"{INVENTORY_SCHEMA}, folder boolean, uri string")
            levels.append(stored(level, "listing"))
            entered = levels[-1].where("folder").where(~F.col("name").isin(*skip) if skip else F.lit(True))
            frontier = entered.select("dir", "uri", F.col("name").alias("below")).repartition(tasks)
        found = reduce(DataFrame.unionAll, levels).where("not folder")
    found = found.drop("folder", "uri")
    return found.filter(has_suffix(F.col("name"), suffixes)) if suffixes else found


def _listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for label, uri, below in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows, lead = [], f"{below}/" if below else ""
            for name, *row in storage.list_folder(f"{uri.rstrip('/')}/{below}" if below else uri):
                rows.append((lead + name, *row))
                if len(rows) == _LISTING_ROWS:
                    yield _listing_batch(label, uri, rows)
                    rows = []
            yield _listing_batch(label, uri, rows)


def _listing_batch(label: str, uri: str, rows: list) -> pa.RecordBatch:
    names = [r[0] for r in rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([label] * len(rows), pa.string()),
            pa.array(names, pa.string()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([int(r[2] * 1e6) for r in rows], pa.timestamp("us", tz="UTC")),
            pa.array([f"{uri.rstrip('/')}/{n}" for n in names], pa.string()),
            pa.array([r[3] for r in rows], pa.bool_()),
            pa.array([uri] * len(rows), pa.string()),
        ],
        names=["dir", "name", "size_bytes", "mtime", "path", "folder", "uri"],
    )


def sorted_listing(inventory: DataFrame) -> DataFrame:
    """Distinct names in code point order."""
    return inventory.select("name").distinct().orderBy("name")


def priority_of(folder: Column, candidates: Sequence[str]) -> Column:
    """Position of ``folder`` among ``candidates`` (from 0), null if it is not one of them."""
    at = F.array_position(F.array(*[F.lit(c) for c in candidates]), folder)
    return F.when(at > 0, at - 1)


def choose_input_dir(
    inventory: DataFrame,
    candidates: Sequence[str] = INPUT_FOLDERS,
    existing: Sequence[str] = (),
) -> DataFrame:
    """One row (dir, files): the first candidate that holds a file.

    If none does, the first of ``existing`` (empty folders) among the candidates, else ``images``.
    """
    fallback = next((c for c in candidates if c in existing), "images")
    counts = (
        inventory.withColumn("rank", priority_of(F.col("dir"), candidates).cast("long"))
        .filter("rank is not null")
        .groupBy("dir", "rank")
        .agg(F.count("*").alias("files"))
    )
    spare = inventory.sparkSession.range(1).select(
        F.lit(fallback).alias("dir"),
        F.lit(len(candidates)).cast("long").alias("rank"),
        F.lit(0).cast("long").alias("files"),
    )
    return counts.unionByName(spare).orderBy("rank").limit(1).select("dir", "files")
