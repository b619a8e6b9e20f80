"""Table against table and table against disk: one tagged set per comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.names import (
    AUDIT_SUFFIXES,
    default_ext_image,
    has_suffix,
    is_junk,
    strip,
)
from rasterloom.operators.metadata import KEY

# Report categories.
REPORTS = {
    "files_missing": "1_imagenes_faltantes_en_disco",
    "files_extra": "2_imagenes_sobrantes_en_disco",
    "ids_only_mapping": "3_ids_solo_en_csv_mapping",
    "ids_only_typicality": "4_ids_solo_en_csv_typicality",
}


def tag_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(value, in_left, in_right) for two one-column tables.

    A union and one grouping replace two distincts and an outer join: copies of a value are
    combined before the only shuffle.
    """
    both = (
        left.toDF("value")
        .select("value", F.lit(1).alias("l"), F.lit(0).alias("r"))
        .union(right.toDF("value").select("value", F.lit(0).alias("l"), F.lit(1).alias("r")))
    )
    return both.groupBy("value").agg(
        (F.max("l") == 1).alias("in_left"), (F.max("r") == 1).alias("in_right")
    )


def expected_names(mapping: DataFrame) -> DataFrame:
    """Distinct file names the mapping asks for, junk names left out."""
    rows = mapping.dropna(subset=[KEY, "image_name"]).filter(~is_junk(F.col("image_name")))
    return rows.select(default_ext_image(F.col("image_name")).alias("image_name")).distinct()


def tagged_ids(mapping: DataFrame, typicality: DataFrame, strip_keys: bool = False) -> DataFrame:
    def ids(df):
        key = F.col(KEY).cast("string")
        return df.select(strip(key) if strip_keys else key)

    left = ids(mapping.dropna(subset=[KEY, "image_name"]))
    return tag_sets(left, ids(typicality.dropna(subset=[KEY])))


def tagged_files(mapping: DataFrame, inventory: DataFrame) -> DataFrame:
    rows = mapping.dropna(subset=[KEY, "image_name"]).filter(~is_junk(F.col("image_name")))
    names = inventory.filter(has_suffix(F.col("name"), AUDIT_SUFFIXES)).select("name")
    return tag_sets(rows.select(default_ext_image(F.col("image_name"))), names)


def left_only(tagged: DataFrame) -> DataFrame:
    return tagged.filter("in_left and not in_right").select("value")


def right_only(tagged: DataFrame) -> DataFrame:
    return tagged.filter("in_right and not in_left").select("value")


def matched(tagged: DataFrame) -> DataFrame:
    return tagged.filter("in_left and in_right").select("value")


def audit_summary(ids: DataFrame, files: DataFrame) -> DataFrame:
    """One row with the four id counts and the five file counts."""
    tags = ids.select(F.lit("ids").alias("kind"), "in_left", "in_right").unionByName(
        files.select(F.lit("files").alias("kind"), "in_left", "in_right")
    )
    only_left, only_right = "in_left and not in_right", "in_right and not in_left"
    counts = {
        "ids_mapping": ("ids", "in_left"),
        "ids_typicality": ("ids", "in_right"),
        "ids_only_mapping": ("ids", only_left),
        "ids_only_typicality": ("ids", only_right),
        "files_expected": ("files", "in_left"),
        "files_on_disk": ("files", "in_right"),
        "files_matched": ("files", "in_left and in_right"),
        "files_missing": ("files", only_left),
        "files_extra": ("files", only_right),
    }
    return tags.agg(
        *[
            F.count_if((F.col("kind") == kind) & F.expr(test)).alias(name)
            for name, (kind, test) in counts.items()
        ]
    )


def audit_report(ids: DataFrame, files: DataFrame) -> DataFrame:
    """(category, value) rows of all four discrepancy lists."""

    def one_sided(tagged, left_name, right_name):
        category = F.when(F.col("in_left"), REPORTS[left_name]).otherwise(REPORTS[right_name])
        one = tagged.filter("in_left <> in_right")
        return one.select(category.alias("category"), "value")

    by_file = one_sided(files, "files_missing", "files_extra")
    return by_file.unionByName(one_sided(ids, "ids_only_mapping", "ids_only_typicality"))
