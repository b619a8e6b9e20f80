"""Input views over the driver tables, as SQL for Spark and for DuckDB.

``documents`` stands for the article mapping, ``labels`` for the scores, ``pages`` for files and
archives, ``embeddings`` for rasters. Every view uses all rows of its table; remainders of the id
only choose which irregularity a row shows (padding, nulls, duplicates, hot keys, empty files).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rasterloom.operators.images import IMAGE_SCHEMA, struct_type, pack
from rasterloom.session import ship
from rasterloom.sources.batches import emit

# Fixed value: folder order of the fixture inventory.
FOLDERS = ["images", "samples", "Samples", "base"]

#: Images, of some 2 KB each, that a task draws.
TASK_ROWS = 1000


def _copies(dialect: str, test: str) -> str:
    """Numbers 0 and, where ``test`` holds, 1: one output row per number."""
    if dialect == "spark":
        return f"explode(sequence(0, CASE WHEN {test} THEN 1 ELSE 0 END))"
    return f"unnest(range(0, CASE WHEN {test} THEN 2 ELSE 1 END))"


def _bytes(dialect: str, text: str) -> str:
    return f"octet_length({text})" if dialect == "spark" else f"strlen({text})"


def view_sql(dialect: str) -> dict[str, str]:
    number = "CAST(CAST(floor(doc_id / 2.0) AS BIGINT) AS STRING)"
    eighth = "CAST(CAST(floor(page_id / 8.0) AS BIGINT) AS STRING)"
    mapping = f"""
SELECT doc_id AS src_ord,
 CASE WHEN doc_id % 31 = 7 THEN NULL
      WHEN doc_id % 10 = 3 THEN 'X' || CAST(doc_id AS STRING)
      WHEN doc_id % 6 = 5 THEN '9'
      WHEN doc_id % 4 = 0 THEN '  ' || CAST(doc_id AS STRING) || ' '
      ELSE CAST(doc_id AS STRING) END AS artikelnummer,
 CASE WHEN doc_id % 13 = 5 THEN NULL
      WHEN doc_id % 13 = 6 THEN '   '
      WHEN doc_id % 13 = 7 THEN ' img_' || {number} || ' '
      WHEN doc_id % 13 = 8 THEN 'img_' || {number} || '.PNG'
      WHEN doc_id % 13 = 9 THEN 'img_' || {number} || '.v2'
      WHEN doc_id % 13 = 10 THEN 'img_' || {number} || '.webp'
      WHEN doc_id % 13 = 11 THEN 'img_' || {number}
      WHEN doc_id % 13 = 12 THEN 'img_1.jpg'
      ELSE 'img_' || {number} || '.jpg' END AS image_name
FROM documents"""
    typicality = f"""
SELECT doc_id + 100000000 * k AS src_ord,
 CASE WHEN k = 1 THEN CAST(doc_id AS STRING)
      WHEN doc_id % 29 = 11 THEN NULL
      WHEN doc_id % 5 = 0 THEN CAST(doc_id AS STRING) || ' '
      ELSE CAST(doc_id AS STRING) END AS artikelnummer,
 CASE WHEN k = 1 THEN CAST(quality AS DOUBLE) + 1
      ELSE CAST(quality AS DOUBLE) - CAST(toxic AS DOUBLE) / 2 END AS typicality,
 CAST(NULL AS STRING) AS _c2
FROM (SELECT doc_id, quality, toxic, {_copies(dialect, "doc_id % 17 = 0 OR doc_id = 9")} AS k FROM labels) AS c"""
    files = f"""
SELECT CASE WHEN k = 1 THEN 'base' WHEN page_id % 3 = 0 THEN 'images'
            WHEN page_id % 3 = 1 THEN 'samples' ELSE 'Samples' END AS dir,
 'img_' || CAST(page_id AS STRING) ||
 CASE WHEN k = 1 THEN '.jpg' WHEN page_id % 7 = 4 THEN '.PNG' WHEN page_id % 7 = 5 THEN '.webp'
      WHEN page_id % 7 = 6 THEN '.txt' ELSE '.jpg' END AS name,
 CASE WHEN k = 1 THEN html || '+' WHEN page_id % 11 = 0 THEN '' ELSE html END AS body
FROM (SELECT page_id, html, {_copies(dialect, "page_id % 6 = 0")} AS k FROM pages) AS c"""
    done = f"""
SELECT CASE WHEN page_id % 3 = 0 THEN 'img_' ELSE 'old_' END || CAST(page_id AS STRING) || '.jpg' AS name,
 CASE WHEN page_id % 6 = 0 THEN CAST(0 AS BIGINT) ELSE CAST({_bytes(dialect, "url")} AS BIGINT) END AS size_bytes
FROM pages"""
    zipped = f"""
SELECT 'a' || lpad(CAST(CAST(floor(page_id / 64.0) AS BIGINT) AS STRING), 8, '0') || '.zip' AS archive,
 page_id AS place,
 CASE WHEN page_id % 10 = 9 THEN 'images/'
      WHEN page_id % 10 = 8 THEN 'images/notes_' || CAST(page_id AS STRING) || '.txt'
      WHEN page_id % 10 = 7 THEN '../img_' || {eighth} || '.jpg'
      WHEN page_id % 10 = 6 THEN 'deep/er/img_' || {eighth} || '.JPG'
      ELSE 'images/img_' || {eighth} || '.jpg' END AS member,
 CASE WHEN page_id % 10 = 9 OR page_id % 8 = 0 THEN '' ELSE html END AS body
FROM pages"""
    disk = f"SELECT dir, name, CAST({_bytes(dialect, 'body')} AS BIGINT) AS size_bytes FROM fx_files"
    return {
        "fx_mapping": mapping,
        "fx_typicality": typicality,
        "fx_files": files,
        "fx_disk": disk,
        "fx_done": done,
        "fx_zip": zipped,
    }


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """One of the SQL views as a DataFrame."""
    sql = view_sql("spark")
    text = sql[view].replace("fx_files", f"({sql['fx_files']}) AS fx_files")
    for table in ("documents", "labels", "pages"):
        path = f"{sf_dir.rstrip('/')}/{table}.parquet"
        text = text.replace(f"FROM {table}", f"FROM parquet.`{path}`")
    return spark.sql(text)


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, orientation, image): one image per embedding, of varying size and channels."""
    ship(spark)
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    made = {"orientation": pa.int32(), "image": struct_type()}

    def drawn(batch):
        for i, v in zip(batch.column("image_id").to_pylist(), batch.column("embedding")):
            image = pack(draw(i, np.asarray(v.as_py(), np.float64)), f"img_{i}")
            yield (i % 8 + 1, image), len(image["data"])

    def build(batches):
        for batch in batches:
            yield from emit(batch, ["image_id"], made, drawn(batch))

    # A short vector becomes a whole image to be worked on, so the rows are spread over all cores, and over more tasks
    # as they grow: what a task holds of them, in each of its steps, stays the same.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vectors.count() // TASK_ROWS))
    spread = vectors.select("vec_id", "embedding").repartition(tasks, "vec_id").withColumnRenamed("vec_id", "image_id")
    return spread.mapInArrow(build, f"image_id long, orientation int, {IMAGE_SCHEMA}")


def draw(image_id: int, vector: np.ndarray) -> np.ndarray:
    """A product photo in miniature: eight by eight cells of shades inside a near-white frame."""
    height, width = 12 + image_id % 29, 12 + image_id * 7 % 31
    shade = np.clip(np.floor((vector + 0.3) / 0.6 * 255), 0, 255).astype(np.int64)
    y, x = np.mgrid[0:height, 0:width]
    row, column = y * 8 // height, x * 8 // width
    frame = (row == 0) | (row == 7) | (column == 0) | (column == 7)
    planes = []
    for channel in range(3):
        q = shade[(row * 8 + column + channel) % 64]
        planes.append(np.where(frame, 240 + q % 16, np.minimum(255, q + (3 * y + 5 * x) % 7)))
    if image_id % 5 == 0:
        planes = planes[:1]
    elif image_id % 5 == 1:
        planes.append(255 - planes[0])
    return np.stack(planes, axis=2).astype(np.uint8)


# The same pixels, after conversion to RGB, for DuckDB.
PIXELS_SQL = """
WITH_SIZE AS (SELECT vec_id AS image_id, embedding AS e, CAST(12 + vec_id % 29 AS INT) AS h,
  CAST(12 + vec_id * 7 % 31 AS INT) AS w FROM embeddings),
CELLS AS (SELECT image_id, h, w, e, CAST(p // w AS INT) AS y, CAST(p % w AS INT) AS x
  FROM (SELECT *, unnest(range(0, h * w)) AS p FROM WITH_SIZE) AS s),
SHADES AS (SELECT image_id, h, w, y, x, (y * 8) // h AS cy, (x * 8) // w AS cx,
  CAST(least(255, greatest(0, floor((CAST(e[1 + ((y * 8) // h * 8 + (x * 8) // w) % 64] AS DOUBLE) + CAST(0.3 AS DOUBLE)) / CAST(0.6 AS DOUBLE) * 255))) AS INT) AS q0,
  CAST(least(255, greatest(0, floor((CAST(e[1 + ((y * 8) // h * 8 + (x * 8) // w + 1) % 64] AS DOUBLE) + CAST(0.3 AS DOUBLE)) / CAST(0.6 AS DOUBLE) * 255))) AS INT) AS q1,
  CAST(least(255, greatest(0, floor((CAST(e[1 + ((y * 8) // h * 8 + (x * 8) // w + 2) % 64] AS DOUBLE) + CAST(0.3 AS DOUBLE)) / CAST(0.6 AS DOUBLE) * 255))) AS INT) AS q2
  FROM CELLS),
PLANES AS (SELECT image_id, h, w, y, x,
  CASE WHEN cy IN (0, 7) OR cx IN (0, 7) THEN 240 + q0 % 16 ELSE least(255, q0 + (3 * y + 5 * x) % 7) END AS v0,
  CASE WHEN cy IN (0, 7) OR cx IN (0, 7) THEN 240 + q1 % 16 ELSE least(255, q1 + (3 * y + 5 * x) % 7) END AS v1,
  CASE WHEN cy IN (0, 7) OR cx IN (0, 7) THEN 240 + q2 % 16 ELSE least(255, q2 + (3 * y + 5 * x) % 7) END AS v2
  FROM SHADES),
fx_pixels AS (SELECT image_id, h, w, y, x, v0 AS r,
  CASE WHEN image_id % 5 = 0 THEN v0 ELSE v1 END AS g,
  CASE WHEN image_id % 5 = 0 THEN v0 ELSE v2 END AS b FROM PLANES)""".replace("WITH_SIZE", "fx_sizes")
