"""Which images are to be processed, from where, and with what outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.names import INGEST_SUFFIXES, has_suffix, target_path
from rasterloom.sources.files import priority_of

# Fixed value: folders searched after the chosen input folder.
FALLBACK_FOLDERS = ("samples", "Samples", "base")


def search_order(chosen: str, fallbacks: Sequence[str] = FALLBACK_FOLDERS) -> list[str]:
    return [chosen, *[f for f in fallbacks if f != chosen]]


def local_samples(table: DataFrame, inventory: DataFrame | None) -> DataFrame:
    """Rows whose image is in the folder; without a folder the table is returned as it is."""
    if inventory is None:
        return table
    names = inventory.select(F.col("name").alias("image_name")).distinct()
    return table.join(names, "image_name", "left_semi")


def pending(table: DataFrame, done: DataFrame) -> DataFrame:
    """Rows without a non-empty output."""
    finished = done.filter("size_bytes > 0").select(F.col("name").alias("image_name")).distinct()
    return table.join(finished, "image_name", "left_anti")


def ingest_union(inventory: DataFrame, members: DataFrame, suffixes=INGEST_SUFFIXES) -> DataFrame:
    """Work list after an ingest: everything in the folder together with the new members."""
    names = inventory.select("name").unionByName(members.select("name"))
    return names.filter(has_suffix(F.col("name"), suffixes)).distinct()


def locate(names: DataFrame, inventory: DataFrame, folders: Sequence[str]) -> DataFrame:
    """Add ``input_path``: the file in the first of ``folders`` that has it, else null."""
    best = _best_folder(inventory, folders).withColumnRenamed("name", "image_name")
    placed = names.join(best, "image_name", "left")
    return placed.withColumn("input_path", _input_path(folders)).drop("rank")


def _best_folder(inventory: DataFrame, folders: Sequence[str]) -> DataFrame:
    ranked = inventory.select("name", priority_of(F.col("dir"), folders).alias("rank"))
    return ranked.filter("rank is not null").groupBy("name").agg(F.min("rank").alias("rank"))


def _input_path(folders: Sequence[str]):
    folder = F.element_at(F.array(*[F.lit(f) for f in folders]), (F.col("rank") + 1).cast("int"))
    return F.when(F.col("rank").isNotNull(), F.concat_ws("/", folder, F.col("image_name")))


def work_plan(
    table: DataFrame, inventory: DataFrame, done: DataFrame, folders: Sequence[str]
) -> DataFrame:
    """Add ``input_path``, ``input_bytes``, ``target`` and ``status`` (skipped, todo or missing).

    Inputs and outputs are reduced to one row per name in a single grouping, and that is joined
    once, on the key by which the metadata is already partitioned.
    """
    rank = priority_of(F.col("dir"), folders).cast("long")
    inputs = inventory.select(
        "name", rank.alias("rank"), "size_bytes", F.lit(0).alias("done")
    ).filter("rank is not null")
    unknown = F.lit(None).cast("long")
    outputs = done.filter("size_bytes > 0").select(
        "name", unknown.alias("rank"), unknown.alias("size_bytes"), F.lit(1).alias("done")
    )
    files = (
        inputs.unionByName(outputs)
        .groupBy(F.col("name").alias("image_name"))
        .agg(
            F.min("rank").alias("rank"),
            F.min_by("size_bytes", "rank").alias("input_bytes"),
            F.max("done").alias("done"),
        )
    )
    status = (
        F.when(F.col("done") == 1, "skipped")
        .when(F.col("rank").isNotNull(), "todo")
        .otherwise("missing")
    )
    return (
        table.join(files, "image_name", "left")
        .withColumn("input_path", _input_path(folders))
        .withColumn("target", target_path(F.col("image_name")))
        .withColumn("status", status)
        .drop("rank", "done")
    )


def missing_inputs(plan: DataFrame) -> DataFrame:
    """Dead-letter rows (image_name, artikelnummer, stage, error) of inputs that were not found."""
    lost = plan.filter("status = 'missing'")
    message = F.concat(F.lit("no input folder holds "), F.col("image_name"))
    return lost.select(
        "image_name", "artikelnummer", F.lit("locate").alias("stage"), message.alias("error")
    )


def outcomes() -> list[Column]:
    """Counts of processed and failed images that come with their write, for ``DataFrame.observe``."""
    good = F.col("status") == "ok"
    return [F.count(F.when(good, 1)).alias("processed"), F.count(F.when(~good, 1)).alias("failed")]


def run_counters(results: DataFrame) -> DataFrame:
    """(status, images) with status processed, skipped or failed."""
    return results.groupBy("status").agg(F.count("*").alias("images"))
