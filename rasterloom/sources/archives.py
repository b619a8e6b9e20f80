"""ZIP archives as rows: member index first, member bytes last."""

from __future__ import annotations

import bz2
import struct
import zipfile
import zlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.functions.names import INGEST_SUFFIXES, basename, has_suffix, raw_unsafe
from rasterloom.session import is_folder, ship, stored
from rasterloom.sources import storage
from rasterloom.sources.batches import CONTENT, CONTENT_SCHEMA, emit, schema_of

INDEX_SCHEMA = (
    "path string, archive string, ord long, member string, is_dir boolean, size_bytes long, "
    "packed_bytes long, method int, offset long, crc long, encrypted boolean, error string"
)
_LOCATION = ["size_bytes", "packed_bytes", "method", "offset", "crc", "encrypted"]
_INDEX_ROWS = 10_000
_TASK_BYTES = 64 << 20


def index_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per member, read from each archive's central directory only.

    The archives themselves are listed without their content, so their size does not matter. Of a
    folder the ``.zip`` files in any case are taken; a file that is named is opened whatever it is called.
    An archive that cannot be opened gives one row with ``error`` set.
    """
    ship(spark)
    paths = [paths] if isinstance(paths, str) else paths
    folders = [p for p in paths if is_folder(spark, p)]
    named = [p for p in paths if p not in folders]
    reader = spark.read.format("binaryFile")
    parts = [reader.load(named).select("path")] if named else []
    if folders:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]")
        parts.append(reader.load(folders).select("path"))
    return reduce(DataFrame.unionAll, parts).mapInArrow(_index_batches, INDEX_SCHEMA)


def _index_batches(batches):
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            archive = uri.rsplit("/", 1)[-1]
            try:
                files, path = storage.locate(uri)
                with files.open_input_file(path) as handle, zipfile.ZipFile(handle) as opened:
                    members = opened.infolist()
                    for start in range(0, len(members), _INDEX_ROWS):
                        yield _index_rows(uri, archive, start, members[start : start + _INDEX_ROWS])
            except Exception as problem:
                row = dict.fromkeys(_index_names())
                row |= {"path": uri, "archive": archive, "error": f"archive_unreadable: {problem}"}
                yield pa.RecordBatch.from_pylist([row], schema=_index_schema())


def _index_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [part.split(" ") for part in INDEX_SCHEMA.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _index_names() -> list[str]:
    return _index_schema().names


def _index_rows(uri, archive, start, members) -> pa.RecordBatch:
    rows = [
        {
            "path": uri,
            "archive": archive,
            "ord": start + i,
            "member": m.filename,
            "is_dir": m.is_dir(),
            "size_bytes": m.file_size,
            "packed_bytes": m.compress_size,
            "method": m.compress_type,
            "offset": m.header_offset,
            "crc": m.CRC,
            "encrypted": bool(m.flag_bits & 1),
            "error": None,
        }
        for i, m in enumerate(members)
    ]
    return pa.RecordBatch.from_pylist(rows, schema=_index_schema())


def ingestable(index: DataFrame, suffixes: Sequence[str] = INGEST_SUFFIXES) -> DataFrame:
    """Plain image members under their base name; a path leading outside is flagged, not lost."""
    return (
        index.filter(~F.col("is_dir"))
        .withColumn("name", basename(F.col("member")))
        .filter(has_suffix(F.col("name"), suffixes))
        .withColumn("raw_unsafe", raw_unsafe(F.col("member")))
    )


def first_non_empty(members: DataFrame) -> DataFrame:
    """One member per name: the first with content, or the last if all copies are empty."""
    empty = F.col("size_bytes") == 0
    order = Window.partitionBy("name").orderBy(
        empty,
        F.when(~empty, F.col("archive")),
        F.when(~empty, F.col("ord")),
        F.when(empty, F.col("archive")).desc(),
        F.when(empty, F.col("ord")).desc(),
    )
    return members.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def new_members(members: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Members whose name is not yet on disk with content (``existing``: name, size_bytes)."""
    if existing is None:
        return members
    present = existing.filter("size_bytes > 0").select("name").distinct()
    return members.join(present, "name", "left_anti")


def read_members(members: DataFrame, partitions: int | None = None) -> DataFrame:
    """Add ``content``, ``status`` and ``error`` by reading each member at its offset.

    Rows that come with an ``error`` keep it.

    Members are spread over tasks by their place in the archive, a fixed number of bytes together, so
    one huge archive is read by many tasks and large members do not meet in one.
    The list of members is stored first: it is needed for sizing, for sampling and for reading.
    """
    spark = members.sparkSession
    ship(spark)
    members = stored(members, "zip-members")
    total = members.agg(F.sum("packed_bytes")).first()[0] or 0
    if partitions is None:
        partitions = max(spark.sparkContext.defaultParallelism, -(-total // _TASK_BYTES))
    piece = max(1, min(_TASK_BYTES, total // (8 * partitions)))
    spread = members.withColumn("_piece", F.floor(F.col("offset") / piece))
    spread = spread.repartition(partitions, "path", "_piece").drop("_piece")
    spread = spread.sortWithinPartitions("path", "offset")
    keep = [c for c in spread.columns if c != "error"]
    return spread.mapInArrow(_content_batches, schema_of(spread, keep, CONTENT_SCHEMA))


def _content_batches(batches):
    handles = {}
    for batch in batches:
        rows = batch.select(["path", "error", *_LOCATION]).to_pylist()
        keep = [n for n in batch.schema.names if n != "error"]
        yield from emit(batch, keep, CONTENT, (_content(handles, r) for r in rows))


def _content(handles: dict, row: dict):
    """Result of one member; the handle of the archive at hand is kept open."""
    if row["error"] is not None:
        return (None, "failed", row["error"]), 0
    try:
        uri = row["path"]
        if uri not in handles:
            while handles:
                handles.popitem()[1].close()
            files, path = storage.locate(uri)
            handles[uri] = files.open_input_file(path)
        data = _member_bytes(handles[uri], row)
        return (data, "ok", None), len(data)
    except Exception as problem:
        return (None, "failed", f"member_unreadable: {problem}"), 0


def _member_bytes(handle, row) -> bytes:
    if row["encrypted"]:
        raise ValueError("encrypted member")
    if row["method"] not in _METHODS:
        data = _by_library(handle, row["offset"])
        if len(data) != row["size_bytes"]:
            raise ValueError("unexpected size")
        return data
    handle.seek(row["offset"])
    header = handle.read(30)
    name_size, extra_size = struct.unpack("<HH", header[26:30])
    handle.seek(row["offset"] + 30 + name_size + extra_size)
    data = _METHODS[row["method"]](handle.read(row["packed_bytes"]))
    if len(data) != row["size_bytes"] or zlib.crc32(data) != row["crc"]:
        raise ValueError("size or checksum mismatch")
    return data


_METHODS = {
    zipfile.ZIP_STORED: bytes,
    zipfile.ZIP_DEFLATED: lambda data: zlib.decompress(data, -15),
    zipfile.ZIP_BZIP2: bz2.decompress,
}


def _by_library(handle, offset: int) -> bytes:
    """The member at ``offset``; names may repeat. The directory is read once per open archive."""
    key = id(handle)
    if _DIRECTORY.get("key") != key:
        opened = zipfile.ZipFile(handle)
        _DIRECTORY.update(key=key, handle=handle, opened=opened, members={m.header_offset: m for m in opened.infolist()})
    with _DIRECTORY["opened"].open(_DIRECTORY["members"][offset]) as member:
        return member.read()


# The directory of the archive at hand; the handle is kept, so its id stays its own.
_DIRECTORY: dict = {}


def read_zip(
    spark: SparkSession,
    paths: str | list[str],
    suffixes: Sequence[str] = INGEST_SUFFIXES,
    existing: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Images of the archives, one per base name, without those already on disk.

    An archive that cannot be opened is a row of its own with status ``failed``.
    """
    index = stored(index_archives(spark, paths), "zip-index")
    usable = ingestable(index.filter("error is null"), suffixes)
    chosen = new_members(first_non_empty(usable), existing)
    broken = index.filter("error is not null").withColumn("name", F.col("archive"))
    return read_members(chosen.unionByName(broken, allowMissingColumns=True), partitions)
