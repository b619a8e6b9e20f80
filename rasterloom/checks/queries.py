"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.checks import views
from rasterloom.checks.views import FOLDERS, load, rasters
from rasterloom.functions import codec, raster
from rasterloom.functions.names import default_ext_image
from rasterloom.operators import audit, images, metadata, metrics
from rasterloom.operators.joins import cap, chunk_plan, first_per, with_position
from rasterloom.operators.metadata import clean_mapping, master_table, merge_metadata
from rasterloom.operators.sampling import eval_sample
from rasterloom.plans import work
from rasterloom.plans.audit import AuditOptions
from rasterloom.plans.audit import audit as audit_folder
from rasterloom.session import shared_dir
from rasterloom.sinks.files import copy_files, write_archives, write_files
from rasterloom.sinks.tables import append_dead_letters, export_csv, write_images, write_reports
from rasterloom.sources.archives import index_archives, read_zip
from rasterloom.sources.files import choose_input_dir, list_files, sorted_listing
from rasterloom.sources.images import decode_images
from rasterloom.sources.tables import drop_artifact_columns, scan_mapping, scan_typicality
from rasterloom.streaming.standardize import file_stream, stream_standardize

# Parameters of the registered runs, also used by the SQL side.
CHUNKS, MAX_SAMPLES, SAMPLE_SIZE, SEED = 7, 100, 20, 42
GRID = [(50, 100), (100, 200), (150, 300), (200, 400)]


def _mapping(spark, sf):
    return load(spark, sf, "fx_mapping")


def _typicality(spark, sf):
    return load(spark, sf, "fx_typicality")


def _disk(spark, sf):
    return load(spark, sf, "fx_disk")


def _done(spark, sf):
    return load(spark, sf, "fx_done")


def _merged(spark, sf):
    return merge_metadata(_mapping(spark, sf), drop_artifact_columns(_typicality(spark, sf)))


def _master(spark, sf):
    return master_table(_mapping(spark, sf), drop_artifact_columns(_typicality(spark, sf)))


def _plan(spark, sf):
    return work.work_plan(_merged(spark, sf), _disk(spark, sf), _done(spark, sf), FOLDERS)


def _ids(spark, sf):
    return audit.tagged_ids(_mapping(spark, sf), _typicality(spark, sf))


def _files(spark, sf):
    return audit.tagged_files(_mapping(spark, sf), _disk(spark, sf))


# --- sources -------------------------------------------------------------------------------


def scan_mapping_query(spark, sf):
    where = shared_dir(spark, "mapping-csv")
    export_csv(_mapping(spark, sf), where, ["src_ord"])
    table = scan_mapping(spark, where)
    source = F.col("src_ord")
    placed = with_position(table, [source], (source["file"], source["block"]))
    return placed.select("position", "artikelnummer", "image_name")


def audit_job(spark, sf):
    """The audit of a data folder written from the fixtures."""
    root = shared_dir(spark, "audit")
    export_csv(_mapping(spark, sf), f"{root}/mapping.csv", ["src_ord"])
    export_csv(_typicality(spark, sf), f"{root}/typicality.csv", ["src_ord"])
    files = first_per(load(spark, sf, "fx_files"), "name", [F.col("dir")])
    write_files(files.select("name", F.col("body").cast("binary").alias("content")), f"{root}/images")
    return audit_folder(spark, AuditOptions(root, "mapping.csv", "typicality.csv"))


def drop_artifact(spark, sf):
    where = shared_dir(spark, "typicality-csv")
    export_csv(_typicality(spark, sf), where, ["src_ord"])
    table = drop_artifact_columns(scan_typicality(spark, where))
    return table.drop("src_ord")


def _stored_files(spark, sf) -> dict[str, str]:
    """Write the fixture files; returns folder label -> path."""
    root = shared_dir(spark, "files")
    files = load(spark, sf, "fx_files")
    named = files.select(F.concat_ws("/", "dir", "name").alias("name"), F.col("body").cast("binary").alias("content"))
    write_files(named, root)
    return {folder: f"{root}/{folder}" for folder in FOLDERS}


def inventory(spark, sf):
    return list_files(spark, _stored_files(spark, sf)).select("dir", "name", "size_bytes")


def name_listing(spark, sf):
    return sorted_listing(_disk(spark, sf))


def _stored_archives(spark, sf) -> str:
    root = shared_dir(spark, "archives")
    members = load(spark, sf, "fx_zip").select(
        "archive", "place", F.col("member").alias("name"), F.col("body").cast("binary").alias("content")
    )
    ordered = members.repartition("archive").sortWithinPartitions("archive", "place")
    write_archives(ordered, root, archive="archive")
    return root


def zip_members(spark, sf):
    found = read_zip(spark, _stored_archives(spark, sf), existing=_done(spark, sf))
    return found.select(
        "name", "archive", "ord", "member", "size_bytes", "raw_unsafe", F.md5("content").alias("digest")
    )


def _bitmaps(spark, sf) -> DataFrame:
    """(name, orientation, content): every raster as a file, some cut short, some empty."""
    rgb = images.to_rgb(rasters(spark, sf)).withColumn("name", _file_name())
    encoded = images.encode_images(rgb, lambda img, name: codec.encode_bmp(img))
    content = (
        F.when(F.col("image_id") % 20 == 0, F.substring(F.col("content"), 1, 20))
        .when(F.col("image_id") % 20 == 1, F.lit(b""))
        .otherwise(F.col("content"))
    )
    return encoded.select("name", "orientation", content.alias("content"))


def _file_name():
    return F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".bmp"))


def decode(spark, sf):
    root = shared_dir(spark, "bitmaps")
    write_files(_bitmaps(spark, sf), root)
    read = decode_images(spark, root)
    return read.select(
        "name",
        *[F.when(F.col("status") == "ok", c).alias(n) for n, c in (("height", F.col("image.height")), ("width", F.col("image.width")), ("digest", F.md5("image.data")))],
        F.coalesce("error", "status").alias("status"),
    )


def choose_dir(spark, sf):
    return choose_input_dir(_disk(spark, sf), FOLDERS)


# --- metadata ------------------------------------------------------------------------------


def format_names(spark, sf):
    name = F.col("image_name")
    return _mapping(spark, sf).select("src_ord", default_ext_image(name).alias("image_name_formatted"))


def merged_literal(spark, sf):
    """Null keys as the text ``nan``, so that they match each other."""
    scores = drop_artifact_columns(_typicality(spark, sf))
    return merge_metadata(_mapping(spark, sf), scores, null_key="literal")


def local_samples(spark, sf):
    return work.local_samples(_merged(spark, sf), _disk(spark, sf).filter("dir = 'samples'"))


def _marked(spark, sf):
    scores = drop_artifact_columns(_typicality(spark, sf))
    return metadata.master_table(_mapping(spark, sf), scores, _disk(spark, sf))


def mark_existing(spark, sf):
    return _marked(spark, sf).select(
        "src_ord", "typicality_ord", "image_name_formatted", "existe_en_disco"
    )


def pending(spark, sf):
    return work.pending(_merged(spark, sf), _done(spark, sf)).select("src_ord", "image_name")


def locate_inputs(spark, sf):
    names = _merged(spark, sf).select("image_name")
    return work.locate(names, _disk(spark, sf), FOLDERS)


def missing_inputs(spark, sf):
    where = shared_dir(spark, "dead-letters")
    append_dead_letters(work.missing_inputs(_plan(spark, sf)), where, "check")
    return spark.read.parquet(where).drop("ts")


def ingest_union(spark, sf):
    from rasterloom.sources.archives import first_non_empty, ingestable

    index = load(spark, sf, "fx_zip").select(
        "archive",
        F.col("place").alias("ord"),
        "member",
        F.octet_length("body").cast("long").alias("size_bytes"),
        F.col("member").endswith("/").alias("is_dir"),
    )
    return work.ingest_union(_disk(spark, sf), first_non_empty(ingestable(index)))


def max_samples(spark, sf):
    order = [F.col("src_ord"), F.col("image_name")]
    return cap(_merged(spark, sf), MAX_SAMPLES, order).select("src_ord", "image_name")


def eval_sample_query(spark, sf):
    names = audit.matched(_files(spark, sf)).withColumnRenamed("value", "name")
    return eval_sample(names, SAMPLE_SIZE, SEED)


def chunk_plan_query(spark, sf):
    placed = chunk_plan(_merged(spark, sf), CHUNKS, [F.col("src_ord")])
    return placed.select("image_name", "position", "chunk")


# --- images --------------------------------------------------------------------------------


def _digest(df: DataFrame, key: str = "image_id") -> DataFrame:
    """One row per image: size and digest of all its bytes."""
    return df.select(
        key,
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.md5("image.data").alias("digest"),
        "status",
    )


def _finished(df: DataFrame) -> DataFrame:
    return images.split_results(df)[0]


def orient(spark, sf):
    return _digest(images.orient(images.to_rgb(rasters(spark, sf))))


def to_rgb(spark, sf):
    return _digest(images.to_rgb(rasters(spark, sf)))


def snap_dims(spark, sf):
    width, height = F.col("image.width"), F.col("image.height")
    target_w, target_h, reason = images.snap_dims(width, height)
    return rasters(spark, sf).select(
        "image_id",
        width.alias("width"),
        height.alias("height"),
        target_w.alias("target_width"),
        target_h.alias("target_height"),
        reason.alias("reason"),
    )


def _with_targets(df: DataFrame) -> DataFrame:
    target_w, target_h, _ = images.snap_dims(F.col("image.width"), F.col("image.height"))
    return df.withColumn("target_width", target_w).withColumn("target_height", target_h)


def _snapped(spark, sf) -> DataFrame:
    return images.resample(_with_targets(rasters(spark, sf)))


def resample(spark, sf):
    return _digest(_snapped(spark, sf))


def grayscale(spark, sf):
    return _digest(images.grayscale(rasters(spark, sf)))


def edge_gradient(spark, sf):
    def step(image):
        gray = raster.luma(raster.to_rgb(image), raster.EDGE_WEIGHTS, raster.EDGE_SHIFT)
        dx, dy = raster.gradient(gray)
        found = raster.edge_classes(gray, 100, 200)
        total = int((np.abs(dx) + np.abs(dy)).sum())
        return [{"gradient": total, "weak": int((found == 1).sum()), "strong": int((found == 2).sum())}]

    return images.measure_images(
        rasters(spark, sf), step, "gradient long, weak long, strong long", ["image_id"]
    ).drop("error")


def edge_map(spark, sf):
    return _digest(images.edge_map(rasters(spark, sf)))


def whiten(spark, sf):
    results = _finished(images.grayscale(_finished(_snapped(spark, sf))))
    return _digest(images.whiten(results, rasters(spark, sf), "image_id"))


def transform_default(spark, sf):
    return _digest(images.standardize(rasters(spark, sf), orientation="orientation"))


def outline_model():
    """Test model: luma with edge pixels set to black."""

    def fn(rgb, control, **params):
        return np.where(control > 0, np.uint8(0), raster.grayscale(rgb))

    return fn


def flatten_model():
    """Test model: 32 levels per step, which removes fine texture."""

    def fn(rgb, **params):
        return rgb // 32 * 32

    return fn


def transform_control(spark, sf):
    return _digest(images.standardize(rasters(spark, sf), outline_model, use_edges=True))


def batched_outline_model():
    """The same model for up to four images at a time."""

    def fn(rgb, control, **params):
        luma = np.stack([raster.grayscale(x) for x in rgb])
        return np.where(control > 0, np.uint8(0), luma)

    fn.batch_size = 4
    return fn


def transform_batches(spark, sf):
    return _digest(images.standardize(rasters(spark, sf), batched_outline_model, use_edges=True))


def run_counters(spark, sf):
    plan = _plan(spark, sf)
    named = rasters(spark, sf).withColumn(
        "image_name", F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".jpg"))
    )
    todo = plan.filter("status = 'todo'").select("image_name")
    loaded = todo.join(named, "image_name", "left").withColumn(
        "error", F.when(F.col("image").isNull(), "decode_failed")
    )
    results = images.standardize(loaded, flatten_model).select(
        F.when(F.col("status") == "ok", "processed").otherwise("failed").alias("status")
    )
    rest = plan.filter("status <> 'todo'").select(
        F.when(F.col("status") == "missing", "failed").otherwise("skipped").alias("status")
    )
    return work.run_counters(results.unionByName(rest))


def _pairs(spark, sf) -> DataFrame:
    """Rows with ``image`` (snapped) and ``result`` (flattened) of the same size."""
    source = _finished(_snapped(spark, sf)).withColumn("source", F.col("image"))
    made = images.standardize(source, flatten_model)
    return made.select("image_id", F.col("source").alias("image"), F.col("image").alias("result"))


def edge_retention(spark, sf):
    return metrics.edge_retention(_pairs(spark, sf), "image_id").drop("error")


def texture_ratio(spark, sf):
    return metrics.texture_ratio(_pairs(spark, sf), "image_id").drop("error")


def param_sweep(spark, sf):
    return metrics.param_sweep(images.to_rgb(rasters(spark, sf)), GRID)


# --- sinks and streams ---------------------------------------------------------------------


def export_roundtrip(spark, sf):
    where = shared_dir(spark, "master-csv")
    export_csv(_master(spark, sf), where, ["src_ord", "typicality_ord"])
    table = scan_typicality(spark, where)
    source = F.col("src_ord")
    placed = with_position(table, [source], (source["file"], source["block"]))
    return placed.select("position", "artikelnummer", "image_name", "typicality")


def audit_report(spark, sf):
    where = shared_dir(spark, "reports")
    write_reports(audit.audit_report(_ids(spark, sf), _files(spark, sf)), where)
    return spark.read.text(where).select("category", "value")


def image_sink(spark, sf):
    where = shared_dir(spark, "image-table")
    write_images(images.standardize(rasters(spark, sf)), where)
    return _digest(spark.read.parquet(where))


def zip_manifest(spark, sf):
    root = shared_dir(spark, "output-zip")
    files = load(spark, sf, "fx_files")
    named = files.select(F.concat_ws("/", "dir", "name").alias("name"), F.col("body").cast("binary").alias("content"))
    write_archives(named, root)
    return index_archives(spark, root).select("member", "size_bytes")


def copy_manifest(spark, sf):
    listed = list_files(spark, _stored_files(spark, sf))
    rank = F.array_position(F.array(*[F.lit(f) for f in FOLDERS]), F.col("dir"))
    first = listed.groupBy("name").agg(F.min_by("path", rank).alias("path"))
    matched = audit.matched(audit.tagged_files(_mapping(spark, sf), listed))
    chosen = eval_sample(matched.withColumnRenamed("value", "name"), SAMPLE_SIZE, SEED)
    copied = copy_files(first.join(chosen, "name"), shared_dir(spark, "samples"))
    return copied.select("name", "size_bytes", "status")


def stream_pending(spark, sf):
    """Files arrive in two waves; three runs leave one output for each file with content."""
    root = shared_dir(spark, "stream")
    files = _bitmaps(spark, sf)
    upright = F.col("orientation") <= 4
    for wave in (upright, ~upright, None):
        if wave is not None:
            write_files(files.filter(wave), f"{root}/in")
        query = stream_standardize(
            file_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/state", decode=codec.decode_bmp
        )
        query.awaitTermination()
    table = spark.read.parquet(f"{root}/out")
    return _digest(table, "name").drop("status").withColumn("ok", F.col("digest").isNotNull())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_mapping": scan_mapping_query,
    "drop_artifact": drop_artifact,
    "inventory": inventory,
    "name_listing": name_listing,
    "zip_members": zip_members,
    "decode": decode,
    "choose_dir": choose_dir,
    "clean_mapping": lambda spark, sf: clean_mapping(_mapping(spark, sf)),
    "format_names": format_names,
    "audit_expected": lambda spark, sf: audit.expected_names(_mapping(spark, sf)),
    "missing_rows": lambda spark, sf: metadata.missing_rows(_marked(spark, sf)),
    "work_plan": _plan,
    "merge_metadata": _merged,
    "merge_metadata_literal": merged_literal,
    "master_table": lambda spark, sf: _master(spark, sf),
    "local_samples": local_samples,
    "mark_existing": mark_existing,
    "pending": pending,
    "locate_inputs": locate_inputs,
    "missing_inputs": missing_inputs,
    "audit_job": audit_job,
    "audit_summary": lambda spark, sf: audit.audit_summary(_ids(spark, sf), _files(spark, sf)),
    "existence_summary": lambda spark, sf: metadata.existence_summary(
        _mapping(spark, sf), _typicality(spark, sf), _disk(spark, sf)
    ),
    "run_counters": run_counters,
    "max_samples": max_samples,
    "eval_sample": eval_sample_query,
    "ids_only_mapping": lambda spark, sf: audit.left_only(_ids(spark, sf)),
    "ids_only_typicality": lambda spark, sf: audit.right_only(_ids(spark, sf)),
    "files_missing": lambda spark, sf: audit.left_only(_files(spark, sf)),
    "files_extra": lambda spark, sf: audit.right_only(_files(spark, sf)),
    "files_matched": lambda spark, sf: audit.matched(_files(spark, sf)),
    "ingest_union": ingest_union,
    "orient": orient,
    "to_rgb": to_rgb,
    "snap_dims": snap_dims,
    "resample": resample,
    "grayscale": grayscale,
    "edge_gradient": edge_gradient,
    "edge_map": edge_map,
    "whiten": whiten,
    "transform_default": transform_default,
    "transform_control": transform_control,
    "transform_batches": transform_batches,
    "export_roundtrip": export_roundtrip,
    "audit_report": audit_report,
    "image_sink": image_sink,
    "zip_manifest": zip_manifest,
    "copy_manifest": copy_manifest,
    "chunk_plan": chunk_plan_query,
    "stream_pending": stream_pending,
    "edge_retention": edge_retention,
    "texture_ratio": texture_ratio,
    "param_sweep": param_sweep,
}
