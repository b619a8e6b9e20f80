"""Cleaning and joining of article metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.names import (
    AUDIT_SUFFIXES,
    default_ext_any,
    default_ext_image,
    has_suffix,
    normalize_key,
    strip,
)
from rasterloom.operators.joins import attach, first_per, hot_keys, inner_pairs
from rasterloom.session import stored

KEY = "artikelnummer"


def clean_mapping(mapping: DataFrame, null_key: str = "drop") -> DataFrame:
    """Strip keys and names, drop rows lacking either, give names without suffix ``.jpg``."""
    cleaned = (
        mapping.withColumn(KEY, normalize_key(F.col(KEY), null_key))
        .withColumn("image_name", strip(F.col("image_name")))
        .dropna(subset=[KEY, "image_name"])
        .filter("image_name != ''")
    )
    return cleaned.withColumn("image_name", default_ext_any(F.col("image_name")))


def _suffix_overlaps(left: DataFrame, right: DataFrame, keep: tuple[str, ...]):
    """Columns on both sides, other than ``keep``, become ``_x`` on the left and ``_y`` on the right."""
    both = [c for c in left.columns if c in right.columns and c not in keep]
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in both}),
        right.withColumnsRenamed({c: f"{c}_y" for c in both}),
    )


def merge_metadata(mapping: DataFrame, typicality: DataFrame, null_key: str = "drop") -> DataFrame:
    """The first row per image name in source order of cleaned names, left joined with scores.

    Only the first score row of a key can survive the de-duplication, so scores are cut to one row
    per key before the join and nothing multiplies.
    """
    left = clean_mapping(mapping, null_key)
    right = typicality.withColumn(KEY, normalize_key(F.col(KEY), null_key)).dropna(subset=[KEY])
    scores = first_per(right, KEY, [F.col("src_ord").asc_nulls_first(), *_ties(right)]).drop("src_ord")
    left, scores = _suffix_overlaps(left, scores, (KEY,))
    # At most one score row a key: the first row of a name is known before the join, and only it goes there.
    # Stored, because the search for hot keys and the join both read it, but the source is read once.
    first = stored(first_per(left, "image_name", [F.col("src_ord"), F.col(KEY)]), "first-names")
    return attach(first, scores, KEY, ["src_ord"])


def _ties(df: DataFrame):
    return [F.col(f"`{c}`") for c in df.columns if c not in ("src_ord", KEY)]


def master_table(
    mapping: DataFrame, typicality: DataFrame, inventory: DataFrame | None = None
) -> DataFrame:
    """Inner join on the stripped key with multiplicity; names are taken as they are.

    With an ``inventory`` each row is also marked as present on disk or not. The mark depends on
    the name alone, so it is set before the join multiplies rows.
    """
    left = mapping.withColumn(KEY, strip(F.col(KEY))).dropna(subset=[KEY])
    right = typicality.withColumn(KEY, strip(F.col(KEY))).dropna(subset=[KEY])
    right = right.withColumnRenamed("src_ord", "typicality_ord")
    hot = hot_keys(left, KEY)
    if inventory is not None:
        left = mark_existing(left, inventory, ["src_ord"])
    left, right = _suffix_overlaps(left, right, (KEY,))
    return inner_pairs(left, right, KEY, ["src_ord"], ["typicality_ord"], hot)


def disk_names(inventory: DataFrame) -> DataFrame:
    """Distinct names with an audit suffix; empty files count."""
    return inventory.filter(has_suffix(F.col("name"), AUDIT_SUFFIXES)).select("name").distinct()


def mark_existing(table: DataFrame, inventory: DataFrame, spread_by: list[str]) -> DataFrame:
    """Add ``image_name_formatted`` and ``existe_en_disco``."""
    named = table.withColumn("image_name_formatted", default_ext_image(F.col("image_name")))
    names = disk_names(inventory).select(
        F.col("name").alias("image_name_formatted"), F.lit(True).alias("_found")
    )
    flagged = attach(named, names, "image_name_formatted", spread_by)
    return flagged.withColumn("existe_en_disco", F.col("_found").isNotNull()).drop("_found")


def missing_rows(marked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return marked.filter("not existe_en_disco").select(KEY, "image_name", "typicality", *keep)


def existence_summary(mapping: DataFrame, typicality: DataFrame, inventory: DataFrame) -> DataFrame:
    """(total, found, missing) over the master table, from counts per key instead of its rows."""
    keyed = mapping.withColumn(KEY, strip(F.col(KEY))).dropna(subset=[KEY])
    copies = (
        typicality.select(strip(F.col(KEY)).alias(KEY))
        .dropna()
        .groupBy(KEY)
        .agg(F.count("*").alias("copies"))
    )
    wanted = keyed.groupBy(KEY, default_ext_image(F.col("image_name")).alias("name")).agg(
        F.count("*").alias("rows")
    )
    asked = (
        attach(wanted, copies, KEY, ["name"], "inner", hot_keys(keyed, KEY))
        .groupBy("name")
        .agg(F.sum(F.col("rows") * F.col("copies")).alias("rows"))
    )
    found = asked.join(disk_names(inventory).withColumn("hit", F.lit(True)), "name", "left")
    return found.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("rows"))), F.lit(0)).alias("found"),
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("rows"))), F.lit(0)).alias("missing"),
    )
