"""Image tables: rows with an ``image`` struct laid out like Spark's image source."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.names import basename
from rasterloom.session import ship
from rasterloom.sources import storage
from rasterloom.sources.batches import CONTENT, CONTENT_SCHEMA, emit, read_ahead, schema_of
from rasterloom.sources.files import list_files


def decode_images(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """Decode the files of folders with Spark's image source: (name, image, status, error).

    Files that cannot be decoded stay as rows with status ``failed``, and so do empty files, which that source passes over;
    they come from a listing, so that no pixels are shuffled.
    """
    folders = [folders] if isinstance(folders, str) else folders
    found = spark.read.format("image").option("dropInvalid", False).load(folders)
    broken = F.col("image.height") < 1
    decoded = found.select(
        F.url_decode(F.regexp_replace(basename(F.col("image.origin")), r"\+", "%2B")).alias("name"),
        "image",
        F.when(broken, "failed").otherwise("ok").alias("status"),
        F.when(broken, "decode_failed").alias("error"),
    )
    listed = list_files(spark, {str(i): folder for i, folder in enumerate(folders)})
    # Neither source reads names that start with a dot or an underscore.
    empty = listed.where("size_bytes = 0").where(~F.col("name").rlike("^[._]"))
    image = F.lit(None).cast(decoded.schema["image"].dataType)
    return decoded.unionAll(empty.select("name", image, F.lit("failed"), F.lit("empty_file")))


def read_content(files: DataFrame, path: str = "input_path") -> DataFrame:
    """Add ``content``, ``status`` and ``error`` to rows that name a file.

    Only names are shuffled before this point; the bytes are read last, where they are used.
    """
    ship(files.sparkSession)
    keep = files.columns

    def read(batches):
        for batch in batches:
            found = read_ahead(batch.column(path).to_pylist())
            results = (((c, "failed" if e else "ok", e), len(c or b"")) for c, e in found)
            yield from emit(batch, keep, CONTENT, results)

    return files.mapInArrow(read, schema_of(files, keep, CONTENT_SCHEMA))


def read_orientation(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``orientation``, the camera tag of JPEG files, null if there is none.

    Spark's image source does not apply the tag; join it to the decoded images by name and use
    ``orient``. Only the header segments of each file are read.
    """
    ship(files.sparkSession)
    keep = files.columns

    def read(batches):
        for batch in batches:
            tags = (((_orientation_of(uri),), 0) for uri in batch.column(path).to_pylist())
            yield from emit(batch, keep, {"orientation": pa.int32()}, tags)

    return files.mapInArrow(read, schema_of(files, keep, "orientation int"))


def _orientation_of(uri: str) -> int | None:
    try:
        files, path = storage.locate(uri)
        with files.open_input_stream(path) as stream:
            if stream.read(2) != b"\xff\xd8":
                return None
            while (mark := stream.read(4)) and mark[0] == 0xFF and mark[1] not in (0xDA, 0xD9):
                body = stream.read(int.from_bytes(mark[2:4], "big") - 2)
                if mark[1] == 0xE1 and body[:6] == b"Exif\0\0":
                    return _tag_in_exif(body[6:])
    except Exception:
        return None
    return None


def _tag_in_exif(tiff: bytes) -> int | None:
    order = {b"II": "little", b"MM": "big"}[tiff[:2]]

    def number(at, size):
        return int.from_bytes(tiff[at : at + size], order)

    start = number(4, 4)
    for i in range(number(start, 2)):
        entry = start + 2 + 12 * i
        if number(entry, 2) == 0x0112:
            return number(entry + 8, 2)
    return None
