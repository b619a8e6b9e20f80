"""Image-table operators: Arrow batch jobs over rows with an ``image`` struct.

Every operator keeps the other columns, adds ``status`` and ``error``, and shuffles nothing.
A failing image becomes a row with status ``failed``; the job goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import raster
from rasterloom.session import qualified, ship, stored
from rasterloom.sources import storage
from rasterloom.sources.batches import CONTENT, CONTENT_SCHEMA, emit, read_ahead, schema_of

IMAGE_FIELDS = "origin: string, height: int, width: int, nChannels: int, mode: int, data: binary"
IMAGE_SCHEMA = f"image struct<{IMAGE_FIELDS}>"

# Storage type codes of 8-bit images by number of channels.
MODES = {1: 0, 3: 16, 4: 24}

# Default prompt and parameters of the model transform.
DEFAULT_PROMPT = (
    "CAD-style monochrome render of the exact object isolated on a pure flat white background, zero drop shadows, no floor shadow. "
    "Clean uniform matte light-grey surface, zero surface texture, "
    "zero patterns, zero logos, zero text, zero color. "
    "no mannequin, no display stand or shelf, only the original object. "
    "High geometric accuracy, sharp structural seams, clipping path isolated"
)
GUIDANCE_SCALE, STEPS, SEED, CONTROL_SCALE = 3.5, 25, 42, 0.75

#: Rasters held for one round of batched model calls; a larger image is a round of its own.
BATCH_BYTES = 64 << 20

_models: dict[str, Callable] = {}


def _swap(img: np.ndarray) -> np.ndarray:
    """Exchange the first and third channel (stored blue first); one channel stays as it is."""
    return img if img.shape[2] == 1 else img[:, :, [2, 1, 0, 3][: img.shape[2]]]


def unpack(struct: dict) -> np.ndarray:
    shape = struct["height"], struct["width"], struct["nChannels"]
    return _swap(np.frombuffer(struct["data"], dtype=np.uint8).reshape(shape))


def pack(img: np.ndarray, origin: str | None) -> dict:
    height, width, channels = img.shape
    data = np.ascontiguousarray(_swap(img), dtype=np.uint8).tobytes()
    return {"origin": origin, "height": height, "width": width, "nChannels": channels, "mode": MODES[channels], "data": data}


def struct_type() -> pa.DataType:
    return pa.struct(
        [("origin", pa.string())]
        + [(n, pa.int32()) for n in ("height", "width", "nChannels", "mode")]
        + [("data", pa.binary())]
    )


RESULT = {"image": struct_type(), "status": pa.string(), "error": pa.string()}
RESULT_SCHEMA = f"{IMAGE_SCHEMA}, status string, error string"


def _rows_of(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[dict]:
    """Rows of the named columns; image bytes are handed over without a copy."""
    columns = [batch.column(n) for n in names]
    readers = [_image_at if pa.types.is_struct(c.type) else _value_at for c in columns]
    parts = [c.flatten() if pa.types.is_struct(c.type) else c for c in columns]
    for i in range(batch.num_rows):
        yield {n: read(p, i) for n, read, p in zip(names, readers, parts)}


def _value_at(column, i: int):
    return column[i].as_py()


def _image_at(parts, i: int) -> dict | None:
    data = parts[-1][i].as_buffer()
    if data is None:
        return None
    small = {n: p[i].as_py() for n, p in zip(("origin", "height", "width", "nChannels"), parts)}
    return small | {"data": data}


class ModelError(Exception):
    """The model could not be built: the task fails, not the image."""


def _attempt(step, row: dict, images: Sequence[str], earlier: str | None):
    """(result, status, error) of one row."""
    if earlier is not None:
        return None, "failed", earlier
    try:
        rasters = {n: unpack(row[n]) for n in images}
        return step(**(row | rasters)), "ok", None
    except ModelError:
        raise
    except Exception as problem:
        return None, "failed", str(problem) or type(problem).__name__


def _outcomes(step: Callable, rows: Iterator[tuple[Callable[[], dict], str | None]]) -> Iterator[tuple]:
    """(result, status, error) of rows (loader of the step's arguments, earlier error), in their order."""
    if hasattr(step, "batches"):
        yield from step.batches(rows)
    else:
        for load, earlier in rows:
            yield _attempt(lambda load=load: step(**load()), {}, (), earlier)


def _in_batches(model, size: int, limit: int, rows, prepare, finish) -> Iterator[tuple]:
    """As ``_outcomes``, with images of one shape in common calls; what is held at a time is bounded by bytes."""
    held, total = [], 0
    for load, earlier in rows:
        held.append(_attempt(lambda load=load: prepare(**load()), {}, (), earlier))
        if held[-1][1] == "ok":
            upright, inputs = held[-1][0]
            total += upright.nbytes + sum(x.nbytes for x in inputs.values())
        if total >= limit:
            yield from _call(model, size, held, finish)
            held, total = [], 0
    yield from _call(model, size, held, finish)


def _call(model, size: int, held: list[tuple], finish) -> list[tuple]:
    """The outcomes of prepared rows. If a common call fails, its images are called alone, and fail alone."""
    shapes: dict[tuple, list[int]] = {}
    for i, (made, status, _) in enumerate(held):
        if status == "ok":
            shapes.setdefault(made[1]["rgb"].shape, []).append(i)

    def together(places):
        inputs = [held[i][0][1] for i in places]
        made = list(model(**{n: np.stack([x[n] for x in inputs]) for n in inputs[0]}))
        if len(made) != len(places):
            raise ValueError(f"model returned {len(made)} images for {len(places)}")
        return made

    out = list(held)
    for places in shapes.values():
        for low in range(0, len(places), size):
            chunk = places[low : low + size]
            made, status, _ = _attempt(lambda chunk=chunk: together(chunk), {}, (), None)
            for nth, i in enumerate(chunk):
                alone = (lambda nth=nth: made[nth]) if status == "ok" else (lambda i=i: together([i])[0])
                out[i] = _attempt(lambda i=i, alone=alone: finish(alone(), held[i][0][0]), {}, (), None)
    return out


def _image_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if df.schema[n].dataType.typeName() == "struct"]


def map_images(df: DataFrame, step: Callable, args: Sequence[str] = ("image",)) -> DataFrame:
    """Replace ``image`` by ``step(**args)``, where image columns arrive as rasters.

    Rows that failed before are carried along untouched.
    """
    ship(df.sparkSession)
    images = _image_columns(df, args)
    keep = [c for c in df.columns if c not in ("image", "status", "error")]
    has_error = "error" in df.columns

    def results(batch):
        before = batch.column("error").to_pylist() if has_error else [None] * batch.num_rows

        def load(row):
            return row | {n: unpack(row[n]) for n in images}

        outcomes = _outcomes(step, ((partial(load, r), e) for r, e in zip(_rows_of(batch, args), before)))
        for row, (made, status, error) in zip(_rows_of(batch, args), outcomes):
            yield _packed(made, (row.get("image") or {}).get("origin"), status, error)

    def run(batches):
        for batch in batches:
            yield from emit(batch, keep, RESULT, results(batch))

    return df.mapInArrow(run, schema_of(df, keep, RESULT_SCHEMA))


def _packed(img: np.ndarray | None, origin: str | None, status: str, error: str | None):
    if img is None:
        return (None, status, error), 0
    return (pack(img, origin), status, error), img.nbytes


def measure_images(
    df: DataFrame,
    step: Callable,
    schema: str,
    keep: Sequence[str],
    args: Sequence[str] = ("image",),
    failed: Sequence[dict] | None = None,
) -> DataFrame:
    """Rows of numbers and ``error`` instead of images: ``step`` returns a list of dicts for each image.

    An image that is absent or cannot be measured gives the rows ``failed``, one of nulls by default, with its
    error.
    """
    ship(df.sparkSession)
    images = _image_columns(df, args)
    names = [part.split()[0] for part in schema.split(",")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in schema.split(",")]

    absent = [dict.fromkeys(names)] if failed is None else list(failed)

    def packed(batch, source, values, errors):
        taken = [batch.column(c).take(pa.array(source, pa.int64())) for c in keep]
        made = [pa.array([v[n] for v in values], t) for n, t in zip(names, types)]
        made.append(pa.array(errors, pa.string()))
        return pa.RecordBatch.from_arrays(taken + made, names=[*keep, *names, "error"])

    def run(batches):
        for batch in batches:
            source, values, errors = [], [], []
            for i, row in enumerate(_rows_of(batch, args)):
                found, state, error = _attempt(step, row, images, None)
                found = found if state == "ok" else absent
                source += [i] * len(found)
                values += found
                errors += [error] * len(found)
                if len(values) >= _MEASURED_ROWS:
                    yield packed(batch, source, values, errors)
                    source, values, errors = [], [], []
            yield packed(batch, source, values, errors)

    return df.mapInArrow(run, schema_of(df, keep, f"{schema}, error string"))


_MEASURED_ROWS = 100_000


def orient(images: DataFrame, tag: str = "orientation") -> DataFrame:
    return map_images(images, lambda image, **tags: raster.orient(image, tags[tag]), ("image", tag))


def to_rgb(images: DataFrame) -> DataFrame:
    return map_images(images, lambda image: raster.to_rgb(image))


def grayscale(images: DataFrame) -> DataFrame:
    return map_images(images, lambda image: raster.grayscale(image))


def snap_dims(width: Column, height: Column, multiple: int = 16) -> tuple[Column, Column, Column]:
    """(target width, target height, reason); a zero target is ``too_small``. No Python involved."""
    target_w = (width - width % multiple).cast("int")
    target_h = (height - height % multiple).cast("int")
    small = F.when((target_w == 0) | (target_h == 0), F.lit("too_small"))
    return target_w, target_h, small


def resample(images: DataFrame, height: str = "target_height", width: str = "target_width") -> DataFrame:
    return map_images(
        images,
        lambda image, **to: raster.resample(raster.to_rgb(image), to[height], to[width]),
        ("image", height, width),
    )


def snapped(image: np.ndarray, multiple: int = 16) -> np.ndarray:
    """RGB raster with both sides cut to a multiple by resampling."""
    rgb = raster.to_rgb(image)
    return raster.resample(rgb, raster.snap(rgb.shape[0], multiple), raster.snap(rgb.shape[1], multiple))


def edge_map(images: DataFrame, low: int = 100, high: int = 200) -> DataFrame:
    return map_images(images, lambda image: raster.edge_map(snapped(image), low, high))


def whiten(results: DataFrame, originals: DataFrame, key: str, threshold: int = 245) -> DataFrame:
    """White background for results whose originals live in another table (joined on ``key``)."""
    source = originals.select(key, F.col("image").alias("original"))
    paired = results.join(source, key)
    return map_images(
        paired,
        lambda image, original: raster.whiten(image, original, threshold),
        ("image", "original"),
    ).drop("original")


def _model(token: str, make_fn: Callable) -> Callable:
    """One model per Python worker; workers are reused between tasks."""
    if token not in _models:
        _models.clear()
        try:
            _models[token] = make_fn()
        except Exception as problem:
            raise ModelError(f"model could not be built: {problem}") from problem
    return _models[token]


def image_step(
    make_fn: Callable | None = None,
    prompt: str = DEFAULT_PROMPT,
    guidance_scale: float = GUIDANCE_SCALE,
    steps: int = STEPS,
    seed: int = SEED,
    use_edges: bool = False,
    control_scale: float = CONTROL_SCALE,
    low: int = 100,
    high: int = 200,
    whiten_above: int | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> Callable:
    """``step(image, tag) -> raster``: orient, RGB, snap, resample, edges, model, whiten.

    ``make_fn()`` is called once per worker and returns ``fn(rgb, **params) -> rgb``; the seed is
    the same for every image. A function with an attribute ``batch_size`` gets up to so many images of one size at once,
    N x H x W x 3, ``control`` too, and returns N images; one that cannot be processed fails alone. A worker holds
    about ``batch_bytes`` of rasters for such calls. ``use_edges`` passes the edge map as ``control``. Without ``make_fn``
    the image is rendered in gray at its own size. If ``make_fn`` itself fails, the task fails.
    """
    token = hashlib.md5(cloudpickle.dumps(make_fn)).hexdigest()
    params = {"prompt": prompt, "guidance_scale": guidance_scale, "steps": steps, "seed": seed}

    def prepare(image, tag=None):
        upright = raster.orient(image, tag)
        if make_fn is None:
            return upright, {}
        rgb = snapped(upright)
        return upright, {"rgb": rgb} | ({"control": raster.edge_map(rgb, low, high)} if use_edges else {})

    def finish(result, upright):
        return result if whiten_above is None else raster.whiten(result, upright, whiten_above)

    def call(**inputs):
        extra = {"control": inputs["control"], "control_scale": control_scale} if use_edges else {}
        return _model(token, make_fn)(inputs["rgb"], **params, **extra)

    def batch_size():
        return int(getattr(_model(token, make_fn), "batch_size", 0)) if make_fn else 0

    def step(image, tag=None):
        upright, inputs = prepare(image, tag)
        if make_fn is None:
            return finish(raster.grayscale(upright), upright)
        if batch_size():
            return finish(call(**{n: x[None] for n, x in inputs.items()})[0], upright)
        return finish(call(**inputs), upright)

    def batches(rows):
        size = batch_size()
        if size:
            yield from _in_batches(call, size, batch_bytes, rows, prepare, finish)
        else:
            for load, earlier in rows:
                yield _attempt(lambda load=load: step(**load()), {}, (), earlier)

    step.batches = batches
    return step


def standardize(
    images: DataFrame, make_fn: Callable | None = None, orientation: str | None = None, **options
) -> DataFrame:
    """The whole image stage in one pass over the table; ``options`` as in ``image_step``."""
    step = image_step(make_fn, **options)
    if orientation is None:
        return map_images(images, step)

    def tagged(load):
        row = load()
        return {"image": row["image"], "tag": row[orientation]}

    def upright(image, **row):
        return step(image, row[orientation])

    upright.batches = lambda rows: step.batches((partial(tagged, load), earlier) for load, earlier in rows)
    return map_images(images, upright, ("image", orientation))


def standardize_files(files: DataFrame, step: Callable, decode: Callable, path: str) -> DataFrame:
    """Read, decode and transform the files named by ``path`` in one pass: rows with ``image``."""
    ship(files.sparkSession)
    keep = files.columns

    def results(uris):
        rows = ((partial(_decoded, content, decode), problem) for content, problem in read_ahead(uris))
        for uri, made in zip(uris, _outcomes(step, rows)):
            yield _packed(made[0], uri, *made[1:])

    def run(batches):
        for batch in batches:
            yield from emit(batch, keep, RESULT, results(batch.column(path).to_pylist()))

    return files.mapInArrow(run, schema_of(files, keep, RESULT_SCHEMA))


def process_files(
    files: DataFrame, step: Callable, decode: Callable, encode: Callable, folder: str, path: str
) -> DataFrame:
    """Read, decode, transform, encode and write to ``folder/name`` in one pass.

    Pixels never leave the Python worker. Returns the stored manifest: the other columns with
    ``size_bytes``, ``status`` and ``error``.
    """
    spark = files.sparkSession
    ship(spark)
    root = qualified(spark, folder)
    keep = files.columns
    added = {"size_bytes": pa.int64(), "status": pa.string(), "error": pa.string()}

    def one(image, name):
        data = encode(image, name)
        attempt = str(TaskContext.get().taskAttemptId())
        stream, finish = storage.open_replacing(f"{root}/{name}", attempt)
        stream.write(data)
        finish()
        return len(data)

    def results(batch):
        contents = read_ahead(batch.column(path).to_pylist())
        rows = ((partial(_decoded, content, decode), problem) for content, problem in contents)
        for name, (image, _, problem) in zip(batch.column("name").to_pylist(), _outcomes(step, rows)):
            yield _attempt(one, {"image": image, "name": name}, (), problem), 0

    def run(batches):
        for batch in batches:
            yield from emit(batch, keep, added, results(batch))

    schema = schema_of(files, keep, "size_bytes long, status string, error string")
    return stored(files.mapInArrow(run, schema), "manifest")


def _decoded(content: bytes, decode: Callable) -> dict:
    if not content:
        raise ValueError("empty_file")
    return {"image": decode(content)}


def split_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(finished images, failed rows without image)."""
    return results.filter("status = 'ok'"), results.filter("status <> 'ok'").drop("image")


def decode_content(files: DataFrame, decode: Callable) -> DataFrame:
    """Turn ``content`` into ``image`` with ``decode(bytes) -> raster``; failures become rows."""
    empty = F.col("content").isNull() | (F.length("content") == 0)
    checked = files.withColumn(
        "error", F.when(F.col("error").isNotNull(), F.col("error")).when(empty, "empty_file")
    )
    decoded = map_images(checked, lambda content: decode(content), ("content",))
    return decoded.drop("content")


def encode_images(images: DataFrame, encode: Callable, name: str = "name") -> DataFrame:
    """Add ``content`` made by ``encode(raster, name) -> bytes``; failures become rows."""
    ship(images.sparkSession)
    keep = [c for c in images.columns if c not in ("image", "status", "error")]

    def results(batch):
        before = batch.column("error").to_pylist()
        for row, earlier in zip(_rows_of(batch, ("image", name)), before):
            made = _attempt(lambda image, **r: encode(image, r[name]), row, ("image",), earlier)
            yield made, len(made[0] or b"")

    def run(batches):
        for batch in batches:
            yield from emit(batch, keep, CONTENT, results(batch))

    return images.mapInArrow(run, schema_of(images, keep, CONTENT_SCHEMA))
