"""The audit as a job: tables against each other and against the files on disk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators import audit as compare
from rasterloom.operators.metadata import existence_summary, master_table, missing_rows
from rasterloom.plans.run import MAPPING_CSV, TYPICALITY_CSV
from rasterloom.session import path_exists, qualified, scratch, stored
from rasterloom.sinks.tables import export_csv, write_reports
from rasterloom.sources.files import list_files
from rasterloom.sources.tables import drop_artifact_columns, scan_mapping, scan_typicality


@dataclass
class AuditOptions:
    """What to compare, below ``data_dir``, and the folder for what is found."""

    data_dir: str = "."
    mapping: str = MAPPING_CSV
    typicality: str = TYPICALITY_CSV
    images: str = "images"
    output: str = "audit"
    nested: bool = False
    multi_line: bool | None = None


def audit(spark: SparkSession, options: AuditOptions) -> DataFrame:
    """Write the reports, the master table and its rows without a file; returns one row with all counts.

    ``reports`` has a folder for each discrepancy list, ``master`` and ``missing`` are CSVs in source order. An
    image folder that does not exist counts as empty. What the audit has stored on its way is removed when it ends.
    """
    with scratch(spark):
        counts = _audit(spark, options)
        return spark.createDataFrame(counts.collect(), counts.schema)  # one row


def _audit(spark: SparkSession, options: AuditOptions) -> DataFrame:
    base = qualified(spark, options.data_dir)
    output = f"{base}/{options.output}"
    mapping = stored(scan_mapping(spark, f"{base}/{options.mapping}", multi_line=options.multi_line), "mapping")
    scores = scan_typicality(spark, f"{base}/{options.typicality}", multi_line=options.multi_line)
    scores = stored(drop_artifact_columns(scores), "typicality")
    folder = f"{base}/{options.images}"
    present = {"images": folder} if path_exists(spark, folder) else {}
    inventory = stored(list_files(spark, present, recurse=options.nested), "inventory")

    ids = stored(compare.tagged_ids(mapping, scores), "tagged-ids")
    files = stored(compare.tagged_files(mapping, inventory), "tagged-files")
    write_reports(compare.audit_report(ids, files), f"{output}/reports")
    marked = stored(master_table(mapping, scores, inventory), "master")
    order = ["src_ord", "typicality_ord"]
    export_csv(marked, f"{output}/master", order)
    export_csv(missing_rows(marked, order), f"{output}/missing", order)
    found = existence_summary(mapping, scores, inventory).first()  # three counts
    return compare.audit_summary(ids, files).withColumns({f"rows_{k}": F.lit(found[k]).cast("long") for k in ("total", "found", "missing")})
