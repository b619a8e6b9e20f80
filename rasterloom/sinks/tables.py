"""Table sinks: CSV export, discrepancy reports, image tables and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_csv(
    df: DataFrame, path: str, order: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """CSV with header; blanks at the ends of values are kept and quotes are doubled.

    Rows follow the ``order`` columns across the files; those columns are not written.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_reports(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per category that has values, one value per line, in order across its files."""
    (
        report.repartitionByRange("category", "value")
        .sortWithinPartitions("category", "value")
        .write.mode(mode)
        .partitionBy("category")
        .text(path)
    )


def write_images(images: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet image table, the primary output."""
    images.write.mode(mode).parquet(path)


def append_dead_letters(rows: DataFrame, path: str, run_id: str, mode: str = "append") -> None:
    """Append (run_id, ts, image_name, artikelnummer, stage, error)."""
    present = set(rows.columns)
    text = {c: F.col(c) if c in present else F.lit(None) for c in ("image_name", "artikelnummer", "stage", "error")}
    rows.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("ts"),
        *[col.cast("string").alias(c) for c, col in text.items()],
    ).write.mode(mode).parquet(path)
