"""A whole run: choose the source, plan the work, process, write, count."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import codec
from rasterloom.functions.names import INGEST_SUFFIXES
from rasterloom.operators import images as stage
from rasterloom.operators.joins import cap
from rasterloom.operators.metadata import merge_metadata
from rasterloom.plans.work import (
    local_samples,
    missing_inputs,
    run_counters,
    search_order,
    work_plan,
)
from rasterloom.session import path_exists, qualified, scratch, stored
from rasterloom.sinks.files import write_archives, write_files
from rasterloom.sinks.tables import append_dead_letters, write_images
from rasterloom.sources.archives import read_zip
from rasterloom.sources.files import INPUT_FOLDERS, choose_input_dir, list_files
from rasterloom.sources.images import read_content
from rasterloom.sources.tables import scan_mapping, scan_typicality

# Places below the data folder.
MAPPING_CSV = "data/artikelnummer_to_image.csv"
TYPICALITY_CSV = "data/article_typicality.csv"
OUTPUT_FOLDER = "images_standardized"
OUTPUT_TABLE = "images_standardized_table"
DEAD_LETTERS = "generation_errors"
FALLBACK_FOLDERS = ("samples", "Samples", ".")
_TASK_BYTES = 64 << 20


@dataclass
class RunOptions:
    """``make_fn`` None is a dry run (gray renders). ``max_samples`` None or 0 means all.

    ``as_table`` writes a Parquet image table instead of encoded files and archives. ``nested``
    looks for inputs and outputs below sub-folders too, for names that contain a path. ``multi_line`` and
    ``inferred_key`` go to the CSV scans; ``multi_line`` None decides by the files.
    """

    data_dir: str = "."
    input_dir: str | None = None
    make_fn: Callable | None = None
    guidance_scale: float = stage.GUIDANCE_SCALE
    steps: int = stage.STEPS
    use_edges: bool = False
    control_scale: float = stage.CONTROL_SCALE
    whiten_above: int | None = None
    max_samples: int | None = None
    samples_only: bool = False
    samples_if_no_images: bool = False
    skip_zip: bool = False
    process_all_zip: bool = False
    zip_file: str = "images.zip"
    output_zip: str = "images_standardized_zip"
    as_table: bool = False
    nested: bool = False
    null_key: str = "drop"
    multi_line: bool | None = None
    inferred_key: str | None = None
    decode: Callable = codec.decode
    encode: Callable = codec.encode


def run(spark: SparkSession, options: RunOptions) -> DataFrame:
    """Process everything still to be done; returns (status, images) counts.

    What the run has stored on its way is removed when it ends.
    """
    with scratch(spark):
        counts = _run(spark, options).collect()  # one row for each status
    return spark.createDataFrame(counts, "status string, images long")


def _run(spark: SparkSession, options: RunOptions) -> DataFrame:
    base = qualified(spark, options.data_dir)
    output = f"{base}/{OUTPUT_TABLE if options.as_table else OUTPUT_FOLDER}"
    run_id = uuid.uuid4().hex
    work, input_dir = _work_list(spark, base, options, run_id)
    done = _done(spark, output, options)
    plan = stored(_plan(spark, base, done, work, input_dir, options.nested), "plan")

    todo = plan.filter("status = 'todo'").withColumnRenamed("image_name", "name")
    tasks = _tasks(spark, todo)
    step = stage.image_step(
        options.make_fn,
        guidance_scale=options.guidance_scale,
        steps=options.steps,
        use_edges=options.use_edges,
        control_scale=options.control_scale,
        whiten_above=options.whiten_above,
    )
    spread = todo.select("name", "artikelnummer", "input_path").repartition(tasks)
    if options.as_table:
        images = stage.standardize_files(spread, step, options.decode, "input_path")
        sized = images.withColumn("size_bytes", F.coalesce(F.length("image.data"), F.lit(0)).cast("long"))
        write_images(sized.drop("input_path"), f"{output}/run={run_id}", "overwrite")
        results = spark.read.parquet(f"{output}/run={run_id}").drop("image")
    else:
        results = stage.process_files(
            spread, step, options.decode, options.encode, output, "input_path"
        )
    failed = results.filter("status <> 'ok'").select(
        F.col("name").alias("image_name"), "artikelnummer", F.lit("process").alias("stage"), "error"
    )
    letters = missing_inputs(plan).unionByName(failed)
    append_dead_letters(letters, f"{base}/{DEAD_LETTERS}", run_id)
    if not (options.skip_zip or options.as_table) and path_exists(spark, output):
        finished = list_files(spark, {"out": output}, recurse=options.nested)
        archived = read_content(finished.select("name", "path").repartition(tasks), "path")
        write_archives(archived, f"{base}/{options.output_zip}")

    outcome = F.when(F.col("status") == "ok", "processed").otherwise("failed")
    outcomes = results.select(outcome.alias("status")).unionByName(
        plan.filter("status <> 'todo'").select(
            F.when(F.col("status") == "missing", "failed").otherwise("skipped").alias("status")
        )
    )
    return run_counters(outcomes)


def _tasks(spark: SparkSession, todo: DataFrame) -> int:
    total = todo.agg(F.sum("input_bytes")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-total // _TASK_BYTES))


def _place(spark: SparkSession, base: str, path: str) -> str:
    """URI of a path that is absolute or below the data folder."""
    absolute = path.startswith("/") or ":/" in path
    return qualified(spark, path) if absolute else f"{base}/{path}"


def _folders(spark: SparkSession, base: str, labels) -> dict[str, str]:
    return {f: f"{base}/{f}" for f in labels if path_exists(spark, f"{base}/{f}")}


def _work_list(spark: SparkSession, base: str, options: RunOptions, run_id: str):
    """(rows with image_name, artikelnummer and order, input folder or None)."""
    images = f"{base}/images"
    has_csv = path_exists(spark, f"{base}/{MAPPING_CSV}")
    if options.skip_zip or options.process_all_zip or not has_csv:
        if not options.skip_zip:
            archive = _place(spark, base, options.zip_file)
            present = None
            if path_exists(spark, images):
                present = list_files(spark, {"images": images}).select("name", "size_bytes")
            taken = write_files(read_zip(spark, archive, existing=present), images)
            lost = taken.filter("error is not null").select(
                F.col("name").alias("image_name"), F.lit("ingest").alias("stage"), "error"
            )
            append_dead_letters(lost, f"{base}/{DEAD_LETTERS}", run_id)
        if not path_exists(spark, images):
            raise FileNotFoundError(f"image folder not found: {images}")
        names = list_files(spark, {"images": images}, INGEST_SUFFIXES)
        rows = names.select(
            F.col("name").alias("image_name"), F.lit(None).cast("string").alias("artikelnummer")
        )
        return cap(rows, options.max_samples, [F.col("image_name")]), options.input_dir
    reading = {"multi_line": options.multi_line, "inferred_key": options.inferred_key}
    table = merge_metadata(
        scan_mapping(spark, f"{base}/{MAPPING_CSV}", **reading),
        scan_typicality(spark, f"{base}/{TYPICALITY_CSV}", **reading),
        options.null_key,
    )
    input_dir = options.input_dir
    wanted = options.samples_only
    if options.samples_if_no_images and not wanted:
        folder = _folders(spark, base, ("images",))
        wanted = not folder or list_files(spark, folder).isEmpty()
    if wanted:
        place = next(iter(_folders(spark, base, ("samples", "Samples")).items()), None)
        inventory = list_files(spark, dict([place])) if place else None
        table = local_samples(table, inventory)
        input_dir = input_dir or "samples"
    table = cap(table, options.max_samples, [F.col("src_ord"), F.col("image_name")])
    return table.select("image_name", "artikelnummer"), input_dir


def _plan(
    spark: SparkSession,
    base: str,
    done: DataFrame,
    work: DataFrame,
    input_dir: str | None,
    nested: bool,
) -> DataFrame:
    labels = dict.fromkeys([*([input_dir] if input_dir else []), *INPUT_FOLDERS])
    tried = {label: _place(spark, base, label) for label in labels}
    present = {uri: uri for uri in tried.values() if path_exists(spark, uri)}
    # The data folder itself is one of them; what a run writes there is no input.
    own = {uri: uri for uri in present if uri == tried.get(".")}
    found = list_files(spark, {u: u for u in present if u not in own}, recurse=nested)
    if own:
        found = found.unionAll(list_files(spark, own, recurse=nested, skip=(OUTPUT_FOLDER, OUTPUT_TABLE, DEAD_LETTERS)))
    inventory = stored(found, "inventory")
    if input_dir is None:
        usual = [tried[label] for label in INPUT_FOLDERS]
        chosen = choose_input_dir(inventory, usual, list(present)).first()["dir"]
    else:
        chosen = tried[input_dir]
    return work_plan(work, inventory, done, search_order(chosen, [tried[f] for f in FALLBACK_FOLDERS]))


def _done(spark: SparkSession, output: str, options: RunOptions) -> DataFrame:
    """(name, size_bytes) of the outputs so far."""
    if not path_exists(spark, output):
        return spark.createDataFrame([], "name string, size_bytes long")
    if options.as_table:
        # A first write that broke off has left no file to take the schema from.
        return spark.read.schema("name string, size_bytes long, run string").parquet(output).select("name", "size_bytes")
    found = list_files(spark, {"out": output}, recurse=options.nested)
    return found.select("name", "size_bytes")
