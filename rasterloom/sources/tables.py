"""CSV tables with a source ordinal, so that file order survives shuffles."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.sources.records import records

# Cell texts that a spreadsheet-style CSV reader takes as null.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: header of an unnamed third column, as exports and as Spark name it.
ARTIFACT_PATTERN = r"^(Unnamed: 2|_c2)$"


def require_columns(df: DataFrame, required: Sequence[str], label: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{label}: missing {missing}; columns found: {df.columns}")
    return df


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    required: Sequence[str] = (),
    numeric: Sequence[str] = (),
    inferred_key: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read a CSV with a header row and add ``src_ord``, the position of each row in its source.

    Values stay text except those named in ``numeric``. ``inferred_key`` sends that column through
    type inference first, so that ``007`` becomes ``7`` when the whole column is integral.
    Records may hold line breaks inside quotes, and files stay split. ``multi_line`` True hands such files to Spark's own
    reader, one task a file; False takes every line as a record.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", bool(multi_line))
    raw = reader.csv(path)
    names = [c.lstrip("\ufeff") for c in raw.columns]
    found = raw.toDF(*names)
    require_columns(found, required, str(path))
    if multi_line is None:
        return _from_records(spark, path, names, numeric, inferred_key)
    block = F.lit(0).cast("long") if multi_line else F.col("_metadata.file_block_start")
    ordinal = F.struct(
        F.col("_metadata.file_path").alias("file"),
        block.alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("src_ord")
    table = raw.select(
        ordinal,
        *[_value(raw[f"`{old}`"], new in numeric).alias(new) for old, new in zip(raw.columns, names)],
    )
    if inferred_key:
        typed = (
            reader.option("inferSchema", True)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .csv(path)
            .toDF(*names)
        )
        kind = typed.schema[inferred_key].dataType.simpleString()
        if kind != "string":
            number = F.trim(F.col(inferred_key)).cast(kind)
            table = table.withColumn(inferred_key, number.cast("string"))
    return table


def _from_records(spark: SparkSession, path, names: list[str], numeric: Sequence[str], inferred_key: str | None) -> DataFrame:
    """The records of split files but the header of each, parsed one by one."""
    found = records(spark, path).where("not (block = 0 and row = 0)")
    fields = ", ".join(f"c{i} STRING" for i in range(len(names)))
    cells = F.from_csv("record", fields, {"escape": '"', "maxCharsPerColumn": "-1"})
    table = found.select(F.struct("file", "block", "row").alias("src_ord"), cells.alias("cells"))
    table = table.select("src_ord", *[_value(F.col(f"cells.c{i}"), name in numeric).alias(name) for i, name in enumerate(names)])
    if inferred_key:
        text = F.trim(F.col(f"`{inferred_key}`"))
        kinds = ["int", "bigint", "double"]
        fits = table.agg(*[F.every(text.isNull() | F.expr(f"try_cast(trim(`{inferred_key}`) AS {k})").isNotNull()).alias(k) for k in kinds]).first()
        kind = next((k for k in kinds if fits[k]), None)
        if kind:
            table = table.withColumn(inferred_key, text.cast(kind).cast("string"))
    return table


def _value(col, numeric: bool):
    kept = F.when(~col.isin(*NULL_TEXTS), col)
    return F.trim(kept).cast("double") if numeric else kept


def scan_mapping(spark: SparkSession, path, **options) -> DataFrame:
    return scan_csv(spark, path, ("artikelnummer", "image_name"), **options)


def scan_typicality(spark: SparkSession, path, **options) -> DataFrame:
    return scan_csv(spark, path, ("artikelnummer",), ("typicality",), **options)


def drop_artifact_columns(df: DataFrame, pattern: str = ARTIFACT_PATTERN) -> DataFrame:
    """Drop spreadsheet leftovers: columns whose name matches ``pattern``."""
    return df.drop(*[c for c in df.columns if re.match(pattern, c)])
