"""File sinks written from tasks. Each returns its manifest as a stored table.

A file appears under its final name only when it is complete, so a task that is run again, or
runs twice, leaves the same files behind.
"""

from __future__ import annotations

import os
import warnings
import zipfile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.session import path_exists, qualified, ship, stored
from rasterloom.sources import storage
from rasterloom.sources.files import list_files

ARCHIVE_BYTES = 1 << 30


def _token() -> str:
    return str(TaskContext.get().taskAttemptId())


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write ``content`` of each row to ``folder/name``; manifest (name, size_bytes, path, error).

    Rows that come with an ``error`` are only listed.
    """
    spark = files.sparkSession
    ship(spark)
    root = qualified(spark, folder)
    has_error = "error" in files.columns

    def write(batches):
        for batch in batches:
            names = batch.column("name").to_pylist()
            errors = batch.column("error").to_pylist() if has_error else [None] * len(names)
            sizes = []
            for name, content, error in zip(names, batch.column("content"), errors):
                data = content.as_py() or b""
                if error is None:
                    stream, finish = storage.open_replacing(f"{root}/{name}", _token())
                    stream.write(data)
                    finish()
                sizes.append(len(data) if error is None else None)
            part = _manifest(names, sizes, [f"{root}/{n}" for n in names])
            yield pa.RecordBatch.from_arrays(
                part.columns + [pa.array(errors, pa.string())], names=part.schema.names + ["error"]
            )

    rows = files.select("name", "content", *(["error"] if has_error else []))
    schema = "name string, size_bytes long, path string, error string"
    return stored(rows.mapInArrow(write, schema), "manifest")


def _manifest(names, sizes, paths) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(paths, pa.string())],
        names=["name", "size_bytes", "path"],
    )


def write_archives(
    files: DataFrame, folder: str, archive: str | None = None, max_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Stream rows (name, content) into ZIP files; manifest (name, size_bytes, path).

    Each partition fills archives of its own and starts a new one after ``max_bytes``; archives that an
    earlier, larger number of partitions left there are removed once the new ones are complete. With an
    ``archive`` column, rows are taken in its order and a change of value starts a new archive of
    that name; the caller has to partition and sort by it.
    """
    spark = files.sparkSession
    ship(spark)
    root = qualified(spark, folder)

    def write(batches):
        part, count = TaskContext.get().partitionId(), 0
        opened, current, label, filled = None, None, None, 0
        for batch in batches:
            names = batch.column("name").to_pylist()
            labels = batch.column(archive).to_pylist() if archive else [None] * len(names)
            sizes, paths = [], []
            for name, wanted, content in zip(names, labels, batch.column("content")):
                data = content.as_py() or b""
                full = archive is None and filled >= max_bytes
                if opened is None or wanted != label or full:
                    if opened is not None:
                        _close(opened)
                    current = wanted or f"part-{part:05d}-{count:04d}.zip"
                    stream, finish = storage.open_replacing(f"{root}/{current}", _token())
                    opened = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED), finish
                    label, filled, count = wanted, 0, count + 1
                with warnings.catch_warnings(action="ignore", category=UserWarning):
                    opened[0].writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED)
                filled += len(data)
                sizes.append(len(data))
                paths.append(f"{root}/{current}")
            yield _manifest(names, sizes, paths)
        if opened is not None:
            _close(opened)

    columns = ["name", "content"] + ([archive] if archive else [])
    rows = files.select(*columns)
    manifest = stored(rows.mapInArrow(write, "name string, size_bytes long, path string"), "manifest")
    if archive is None and path_exists(spark, root):
        _remove_stale(manifest, root)
    return manifest


def _remove_stale(manifest: DataFrame, root: str) -> None:
    """Remove this sink's own archives in ``root`` that are not in the manifest."""
    there = list_files(manifest.sparkSession, {"out": root}).filter(F.col("name").rlike(r"^part-\d{5,}-\d{4,}\.zip$"))
    stale = there.select("name").join(
        manifest.select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct(), "name", "left_anti"
    )

    def remove(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                storage.remove(f"{root}/{name}")
            yield batch

    stale.mapInArrow(remove, "name string").write.format("noop").mode("overwrite").save()


def _close(opened) -> None:
    archive, finish = opened
    archive.close()
    finish()


def copy_files(files: DataFrame, folder: str) -> DataFrame:
    """Copy ``path`` to ``folder/name`` keeping its time; manifest (name, size_bytes, path, status).

    A source that has gone gives a row with status ``missing``.
    """
    spark = files.sparkSession
    ship(spark)
    root = qualified(spark, folder)

    def copy(batches):
        for batch in batches:
            names = batch.column("name").to_pylist()
            sizes, paths, status = [], [], []
            for name, source in zip(names, batch.column("path").to_pylist()):
                target = f"{root}/{name}"
                try:
                    sizes.append(_copy(source, target))
                    status.append("copied")
                except FileNotFoundError:
                    sizes.append(None)
                    status.append("missing")
                paths.append(target)
            part = _manifest(names, sizes, paths)
            yield pa.RecordBatch.from_arrays(
                part.columns + [pa.array(status, pa.string())], names=part.schema.names + ["status"]
            )

    rows = files.select("name", "path")
    schema = "name string, size_bytes long, path string, status string"
    return stored(rows.mapInArrow(copy, schema), "manifest")


def _copy(source: str, target: str) -> int:
    files, path = storage.locate(source)
    info = files.get_file_info(path)
    with files.open_input_stream(path) as reader:
        stream, finish = storage.open_replacing(target, _token())
        while chunk := reader.read(1 << 20):
            stream.write(chunk)
        finish()
    local, where = storage.locate(target)
    if local.type_name == "local" and info.mtime is not None:
        os.utime(where, (info.mtime.timestamp(), info.mtime.timestamp()))
    return info.size
