import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rasterloom.checks import views
from rasterloom.functions import codec, raster
from rasterloom.operators import images, metrics
from rasterloom.operators.images import pack, unpack
from rasterloom.sources.batches import CONTENT, emit

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests

RNG = np.random.default_rng(3)
ARRAYS = {
    "gray": RNG.integers(0, 256, (20, 33, 1)).astype(np.uint8),
    "rgb": RNG.integers(0, 256, (32, 16, 3)).astype(np.uint8),
    "rgba": RNG.integers(0, 256, (17, 40, 4)).astype(np.uint8),
    "small": RNG.integers(0, 256, (9, 40, 3)).astype(np.uint8),
}


@pytest.fixture
def table(spark):
    rows = [(n, 6, pack(a, n)) for n, a in ARRAYS.items()]
    return spark.createDataFrame(rows, f"name string, tag int, {images.IMAGE_SCHEMA}").repartition(3)


def results(df):
    return {r["name"]: r for r in df.collect()}


def arrays(df):
    return {n: unpack(r["image"].asDict()) for n, r in results(df).items() if r["image"]}


def test_single_operators(table):
    assert all((a == raster.to_rgb(ARRAYS[n])).all() for n, a in arrays(images.to_rgb(table)).items())
    turned = arrays(images.orient(table, "tag"))
    assert all((a == np.rot90(ARRAYS[n], -1)).all() for n, a in turned.items())
    assert all((a[..., 0] == a[..., 2]).all() for a in arrays(images.grayscale(table)).values())


def test_failures_stay_rows_and_are_carried_along(table):
    snapped = table.withColumn("h", F.col("image.height") - F.col("image.height") % 16).withColumn("w", F.lit(16))
    first = images.resample(snapped, "h", "w")
    rows = results(first)
    assert rows["small"]["status"] == "failed" and "too_small" in rows["small"]["error"]
    again = results(images.grayscale(first))
    assert again["small"]["error"] == rows["small"]["error"] and len(again) == 4
    done, failed = images.split_results(first)
    assert done.count() == 3 and failed.count() == 1 and "image" not in failed.columns


def counting_model():
    """Fails on one image; reports how often it was built."""

    def fn(rgb, prompt, guidance_scale, steps, seed):
        assert (guidance_scale, steps, seed) == (1.5, 4, 42) and prompt
        if rgb.shape[:2] == (32, 16):
            raise RuntimeError("model refused")
        return 255 - rgb

    return fn


def test_model_transform(table):
    rows = results(images.standardize(table, counting_model, guidance_scale=1.5, steps=4))
    assert {n: r["status"] for n, r in rows.items()} == {"gray": "ok", "rgba": "ok", "rgb": "failed", "small": "failed"}
    assert rows["rgb"]["error"] == "model refused"
    want = 255 - raster.resample(raster.to_rgb(ARRAYS["gray"]), 16, 32)
    assert (unpack(rows["gray"]["image"].asDict()) == want).all()


def broken_model():
    raise OSError("no weights")


def test_a_model_that_cannot_be_built_fails_the_job(table):
    with pytest.raises(Exception, match="no weights"):
        images.standardize(table, broken_model).collect()


def test_control_image_and_scale_reach_the_model(table):
    def make():
        def fn(rgb, control, control_scale, **params):
            return (control * control_scale).astype(np.uint8)

        return fn

    got = arrays(images.standardize(table, make, use_edges=True, control_scale=0.2))
    assert all(set(np.unique(a)) <= {0, 51} for a in got.values())


def test_whitening_in_the_same_pass_and_as_a_join(table):
    white = images.map_images(table, lambda image: np.full_like(raster.to_rgb(image), 246))
    fused = arrays(images.standardize(white.drop("status", "error"), whiten_above=245))
    assert all((a == 255).all() for a in fused.values())
    joined = arrays(images.whiten(images.grayscale(table), white, "name"))
    assert len(joined) == 4 and all((a == 255).all() for a in joined.values())
    assert all((a < 255).any() for a in arrays(images.whiten(images.grayscale(table), table, "name")).values())


def test_decode_and_encode_columns(spark):
    img = ARRAYS["rgb"]
    rows = [("a.bmp", codec.encode_bmp(img), None), ("b.bmp", b"", None), ("c.bmp", b"xx", None), ("d.bmp", None, "read_failed")]
    files = spark.createDataFrame(rows, "name string, content binary, error string")
    decoded = images.decode_content(files, codec.decode_bmp)
    errors = {n: r["error"] for n, r in results(decoded).items()}
    assert errors["a.bmp"] is None and errors["b.bmp"] == "empty_file" and errors["d.bmp"] == "read_failed"
    assert "decode_failed" in errors["c.bmp"]
    encoded = results(images.encode_images(decoded, codec.encode))
    assert bytes(encoded["a.bmp"]["content"]) == rows[0][1] and encoded["c.bmp"]["status"] == "failed"


def test_metrics(spark, table):
    done = images.to_rgb(table)
    same = metrics.edge_retention(done.withColumn("result", F.col("image")), "name").collect()
    assert all(r["retention"] == 1.0 for r in same)
    flat = images.map_images(done, lambda image: np.zeros_like(image)).select("name", F.col("image").alias("result"))
    pairs = done.select("name", "image").join(flat, "name")
    assert all(r["suppression"] == 1.0 for r in metrics.texture_ratio(pairs, "name").collect())
    blank = pairs.select("name", F.col("result").alias("image"), "result")
    assert all(r["suppression"] is None for r in metrics.texture_ratio(blank, "name").collect())
    assert all(r["retention"] is None for r in metrics.edge_retention(blank, "name").collect())


def test_sweep_counts_each_image_once_per_setting(table):
    rows = {(r["low"], r["high"]): r for r in metrics.param_sweep(table, [(50, 100), (200, 400), (50, 100)]).collect()}
    assert set(rows) == {(50, 100), (200, 400)}
    for (low, high), row in rows.items():
        masks = [raster.edges(a, low, high) for a in ARRAYS.values()]
        assert (row["images"], row["edges"]) == (4, sum(int(m.sum()) for m in masks))


def test_sweep_takes_any_grid_and_counts_failures(spark, table):
    one = images.to_rgb(table).filter("name = 'a'") if "a" in ARRAYS else images.to_rgb(table).limit(1)
    grid = [(i, i + 1) for i in range(1500)]
    assert metrics.param_sweep(one, grid).count() == 1500
    broken = one.withColumn("image", F.lit(None).cast(one.schema["image"].dataType))
    rows = metrics.param_sweep(one.unionByName(broken), [(50, 100), (200, 400)]).collect()
    assert {(r["low"], r["high"]) for r in rows} == {(50, 100), (200, 400)}
    assert all((r["images"], r["failed"]) == (1, 1) for r in rows)
    errors = [r["error"] for r in metrics.texture_ratio(broken.withColumn("result", F.col("image")), "name").collect()]
    assert len(errors) == 1 and errors[0]


def counted_model():
    """Inverts images, up to three at a time; marks how many came at once in the first pixel; refuses a black corner."""

    def fn(rgb, **params):
        assert rgb.ndim == 4 and len({x.shape for x in rgb}) == 1
        if (rgb[:, -1, -1] == 0).all(axis=1).any():
            raise ValueError("black corner")
        out = 255 - rgb
        out[:, 0, 0] = len(rgb)
        return out

    fn.batch_size = 3
    return fn


@pytest.mark.parametrize("held", [64 << 20, 1])
def test_batched_model_calls(spark, held):
    made = {f"a{i}": np.full((16, 32, 3), 10 + i, np.uint8) for i in range(7)}
    made |= {"b": np.full((32, 32, 3), 50, np.uint8), "small": np.full((9, 9, 3), 50, np.uint8)}
    rows = [(n, 1, pack(a, n), None) for n, a in made.items()] + [("lost", 1, None, "not_found")]
    frame = spark.createDataFrame(rows, f"name string, tag int, {images.IMAGE_SCHEMA}, error string").coalesce(1)
    for tag in (None, "tag"):
        got = results(images.standardize(frame, counted_model, orientation=tag, batch_bytes=held))
        assert {n for n, r in got.items() if r["status"] == "failed"} == {"small", "lost"} and got["lost"]["error"] == "not_found"
        came = {n: unpack(r["image"].asDict()) for n, r in got.items() if r["image"]}
        assert all((came[n][1:] == 255 - made[n][1:]).all() for n in came)
        together = [1, 3, 3, 3, 3, 3, 3] if held > 1 else [1] * 7
        assert sorted(int(came[f"a{i}"][0, 0, 0]) for i in range(7)) == together and came["b"][0, 0, 0] == 1
    dark = made["a1"].copy()
    dark[-1, -1] = 0
    rows[1] = ("a1", 1, pack(dark, "a1"), None)
    frame = spark.createDataFrame(rows, frame.schema).coalesce(1)
    got = results(images.standardize(frame, counted_model))
    assert {n: r["error"] for n, r in got.items() if r["status"] == "failed" and n != "small"} == {"a1": "black corner", "lost": "not_found"}
    assert len(got) == len(rows)


def test_batches_of_any_size_leave_in_small_parts():
    """A worker holds a few MB of results at a time, whatever comes in at once."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(40))], names=["n"])
    made = (((b"x" * (1 << 20), "ok", None), 1 << 20) for _ in range(40))
    parts = list(emit(batch, ["n"], CONTENT, made))
    assert pa.Table.from_batches(parts).column("n").to_pylist() == list(range(40))
    assert max(p.nbytes for p in parts) < 6 << 20


def test_drawn_rasters_leave_in_small_parts(spark, tmp_path, monkeypatch):
    vectors = spark.createDataFrame([(i, [0.1] * 64) for i in range(8)], "vec_id long, embedding array<float>")
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    builds, before = [], type(vectors).mapInArrow
    monkeypatch.setattr(type(vectors), "mapInArrow", lambda df, build, schema: builds.append(build) or before(df, build, schema))
    assert {(r.image_id, r.orientation) for r in views.rasters(spark, str(tmp_path)).collect()} == {(i, i % 8 + 1) for i in range(8)}
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), pa.array([[0.1] * 64] * 6000, pa.list_(pa.float32()))], names=["image_id", "embedding"])
    parts = list(builds[0](iter([batch])))
    assert sum(p.num_rows for p in parts) == 6000 and max(p.nbytes for p in parts) < 6 << 20


def test_a_task_draws_a_bounded_number_of_rasters(spark, tmp_path, monkeypatch):
    vectors = spark.createDataFrame([(i, [0.1] * 64) for i in range(400)], "vec_id long, embedding array<float>")
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(views, "TASK_ROWS", 20, raising=False)
    made = views.rasters(spark, str(tmp_path)).select("image_id", F.spark_partition_id().alias("task")).collect()
    tasks = [r["task"] for r in made]
    assert sorted(r["image_id"] for r in made) == list(range(400))
    assert max(map(tasks.count, set(tasks))) <= 40
