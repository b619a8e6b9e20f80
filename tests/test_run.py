import gc
import os
import shutil
import zipfile

import numpy as np
import pandas as pd
import pytest

from rasterloom.functions import codec, raster
from rasterloom.plans.run import RunOptions, run
from rasterloom.streaming import standardize
from rasterloom.streaming.standardize import file_stream, stream_standardize

RNG = np.random.default_rng(11)
IMAGES = {f"i{n}.bmp": RNG.integers(0, 256, (17 + n, 40, 3)).astype(np.uint8) for n in range(6)}


def counts(spark, where, **options):
    result = run(spark, RunOptions(data_dir=str(where), **options))
    return {r["status"]: r["images"] for r in result.collect()}


def put(folder, names):
    folder.mkdir(parents=True, exist_ok=True)
    for name in names:
        (folder / name).write_bytes(codec.encode_bmp(IMAGES[name]))


def test_folder_run_resumes(spark, tmp_path):
    put(tmp_path / "images", IMAGES)
    (tmp_path / "images" / "bad.png").write_bytes(b"nothing")
    (tmp_path / "images" / "note.txt").write_bytes(b"text")
    assert counts(spark, tmp_path, skip_zip=True, max_samples=3) == {"processed": 2, "failed": 1}
    assert counts(spark, tmp_path, skip_zip=True) == {"processed": 4, "failed": 1, "skipped": 2}
    out = tmp_path / "images_standardized"
    assert sorted(os.listdir(out)) == sorted(IMAGES)
    for name, img in IMAGES.items():
        assert (codec.decode_bmp((out / name).read_bytes()) == raster.grayscale(img)).all()
    (out / "i0.bmp").write_bytes(b"")
    assert counts(spark, tmp_path, skip_zip=True) == {"processed": 1, "failed": 1, "skipped": 5}
    letters = spark.read.parquet(str(tmp_path / "generation_errors"))
    assert letters.select("run_id").distinct().count() == 3
    assert {r["stage"] for r in letters.collect()} == {"process"}


def test_table_output_resumes(spark, tmp_path):
    put(tmp_path / "images", ["i0.bmp", "i1.bmp"])
    (tmp_path / "images" / "bad.bmp").write_bytes(b"BM")
    options = {"skip_zip": True, "as_table": True}
    assert counts(spark, tmp_path, **options) == {"processed": 2, "failed": 1}
    put(tmp_path / "images", ["i2.bmp"])
    assert counts(spark, tmp_path, **options) == {"processed": 1, "failed": 1, "skipped": 2}
    table = spark.read.parquet(str(tmp_path / "images_standardized_table")).filter("status = 'ok'")
    made = {r["name"]: r["image"] for r in table.collect()}
    assert sorted(made) == ["i0.bmp", "i1.bmp", "i2.bmp"]
    assert bytes(made["i2.bmp"]["data"]) == raster.grayscale(IMAGES["i2.bmp"]).tobytes()


def test_archive_run(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "images.zip", "w") as out:
        for name, img in IMAGES.items():
            out.writestr(f"images/{name}", codec.encode_bmp(img))
    path = tmp_path / "images.zip"
    data = bytearray(path.read_bytes())
    data[data.index(b"images/i5.bmp") + 200] ^= 0xFF
    path.write_bytes(data)
    put(tmp_path / "images", ["i0.bmp"])
    assert counts(spark, tmp_path) == {"processed": 5}
    letters = spark.read.parquet(str(tmp_path / "generation_errors")).collect()
    assert [(r["image_name"], r["stage"]) for r in letters] == [("i5.bmp", "ingest")]
    packed = {}
    for path in (tmp_path / "images_standardized_zip").glob("*.zip"):
        with zipfile.ZipFile(path) as opened:
            packed |= {n: opened.read(n) for n in opened.namelist()}
    assert sorted(packed) == sorted(set(IMAGES) - {"i5.bmp"})
    assert (codec.decode_bmp(packed["i3.bmp"]) == raster.grayscale(IMAGES["i3.bmp"])).all()


@pytest.fixture
def with_csv(tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "artikelnummer_to_image.csv").write_text(
        "artikelnummer,image_name\n1,i0.bmp\n2, i1.bmp\n3,i0.bmp\n4,gone\n5,i2.bmp\n"
    )
    (tmp_path / "data" / "article_typicality.csv").write_text("artikelnummer,typicality,\n1,0.5,\n")
    put(tmp_path / "images", ["i0.bmp"])
    put(tmp_path / "samples", ["i1.bmp"])
    put(tmp_path, ["i2.bmp"])
    return tmp_path


def test_table_run_looks_in_all_folders(spark, with_csv):
    assert counts(spark, with_csv) == {"processed": 3, "failed": 1}
    letters = spark.read.parquet(str(with_csv / "generation_errors")).collect()
    assert [(r["image_name"], r["artikelnummer"], r["stage"]) for r in letters] == [("gone.jpg", "4", "locate")]


def test_names_with_a_path(spark, with_csv):
    (with_csv / "data" / "artikelnummer_to_image.csv").write_text("artikelnummer,image_name\n1,sub.dir/i4.bmp\n")
    put(with_csv / "images" / "sub.dir", ["i4.bmp"])
    assert counts(spark, with_csv, skip_zip=False) == {"failed": 1}
    assert counts(spark, with_csv, nested=True) == {"processed": 1}
    assert counts(spark, with_csv, nested=True) == {"skipped": 1}
    assert (with_csv / "images_standardized" / "sub.dir" / "i4.bmp").exists()


def test_input_folder_elsewhere(spark, with_csv, tmp_path_factory):
    other = tmp_path_factory.mktemp("other")
    put(other, ["i0.bmp"])
    (other / "gone.jpg").write_bytes(codec.encode_bmp(IMAGES["i5.bmp"]))
    (with_csv / "images" / "i0.bmp").write_bytes(b"not used")
    encode = {"encode": lambda img, name: codec.encode_bmp(img)}
    assert counts(spark, with_csv, input_dir=str(other), **encode) == {"processed": 4}
    put(with_csv / "inner", ["i3.bmp"])
    (with_csv / "data" / "artikelnummer_to_image.csv").write_text("artikelnummer,image_name\n1,i3.bmp\n")
    assert counts(spark, with_csv, input_dir="inner") == {"processed": 1}


def test_missing_folder_and_archive_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="image folder"):
        counts(spark, tmp_path, skip_zip=True)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        counts(spark, tmp_path)


def test_samples_only(spark, with_csv):
    def make():
        return lambda rgb, control, **params: control

    got = counts(spark, with_csv, samples_only=True, make_fn=make, use_edges=True)
    assert got == {"processed": 1}
    made = codec.decode_bmp((with_csv / "images_standardized" / "i1.bmp").read_bytes())
    assert made.shape == (16, 32, 3) and set(np.unique(made)) <= {0, 255}


def test_samples_are_used_when_there_are_no_images(spark, with_csv):
    os.remove(with_csv / "images" / "i0.bmp")
    assert counts(spark, with_csv, samples_if_no_images=True) == {"processed": 1}


def test_stream_processes_each_file_once(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def once():
        query = stream_standardize(file_stream(spark, str(source)), out, state)
        query.awaitTermination()
        assert query.exception() is None
        return {r["name"]: r["status"] for r in spark.read.parquet(out).collect()}, spark.read.parquet(out).count()

    put(source, ["i0.bmp", "i1.bmp"])
    (source / "bad.bmp").write_bytes(b"BM")
    (source / "note.txt").write_bytes(b"x")
    first, rows = once()
    assert first == {"i0.bmp": "ok", "i1.bmp": "ok", "bad.bmp": "failed"} and rows == 3
    put(source, ["i2.bmp"])
    second, rows = once()
    assert set(second) == {"i0.bmp", "i1.bmp", "i2.bmp", "bad.bmp"} and rows == 4
    assert once()[1] == 4


def test_a_lost_stream_state_does_not_repeat_finished_work(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, ["i0.bmp"])
    stream_standardize(file_stream(spark, str(source)), out, str(tmp_path / "s")).awaitTermination()
    put(source, ["i1.bmp"])
    os.utime(source / "i0.bmp")
    stream_standardize(file_stream(spark, str(source)), out, str(tmp_path / "s")).awaitTermination()
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == ["i0.bmp", "i1.bmp"]


@pytest.mark.parametrize("provider", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_a_batch_opens_only_the_outputs_of_names_that_come_again(spark, tmp_path, monkeypatch, provider):
    source, late, last, out = tmp_path / "in" / "a", tmp_path / "in" / "b", tmp_path / "in" / "c", tmp_path / "out"
    opened, real = [], standardize.finished
    monkeypatch.setattr(standardize, "finished", lambda s, o, batches: opened.append(batches) or real(s, o, batches))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, f"org.apache.spark.sql.execution.streaming.state.{provider}")

    def once():
        query = stream_standardize(file_stream(spark, str(tmp_path / "in" / "*")), str(out), str(tmp_path / "s"))
        query.awaitTermination()
        assert query.exception() is None
        read = spark.read.parquet(str(out)).selectExpr("name", "cast(batch AS INT) AS batch", "status")
        return query.lastProgress, sorted(map(tuple, read.collect()))

    try:
        for n in range(5):  # nothing comes again: no output is opened, however many there are
            put(source, [f"i{n}.bmp"])
            progress, rows = once()
            assert progress["stateOperators"][0]["numRowsTotal"] == n + 1 and len(rows) == n + 1
        assert opened == []
        (source / "bad.bmp").write_bytes(b"BM")
        once()
        put(late, ["i1.bmp", "i3.bmp"])  # one is finished, of one the output is lost, one had failed
        (late / "bad.bmp").write_bytes(b"BM")
        shutil.rmtree(out / "batch=3")
        rows = once()[1]
        assert opened == [[1, 3, 5]]
        assert [(n, b) for n, b, _ in rows] == [("bad.bmp", 5), ("bad.bmp", 6), ("i0.bmp", 0), ("i1.bmp", 1), ("i2.bmp", 2), ("i3.bmp", 6), ("i4.bmp", 4)]
        put(last, ["i3.bmp"])
        assert once()[1] == rows and opened[1:] == [[3, 6]]
    finally:
        spark.conf.set(key, before)


def test_table_output_resumes_after_a_first_write_that_broke_off(spark, tmp_path):
    put(tmp_path / "images", ["i0.bmp"])
    rest = tmp_path / "images_standardized_table" / "run=x" / "_temporary" / "0"
    rest.mkdir(parents=True)
    assert counts(spark, tmp_path, skip_zip=True, as_table=True) == {"processed": 1}
    assert counts(spark, tmp_path, skip_zip=True, as_table=True) == {"skipped": 1}


def test_a_worker_gathers_a_bounded_number_of_names(spark, tmp_path, monkeypatch):
    """The tables that Spark keeps for the names of a batch do not add up with the names of a partition."""
    source, out, log, real = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log"), standardize._remember

    def remember(key, parts, state):
        alive = sum(isinstance(x, pd.DataFrame) for x in gc.get_objects())
        with open(log, "a") as lines:
            lines.write(f"{alive}\n")
        yield from real(key, parts, state)

    monkeypatch.setattr(standardize, "_remember", remember)
    monkeypatch.setattr(standardize, "STATE_ROWS", 20)
    source.mkdir()
    for n in range(120):
        (source / f"f{n}.bmp").write_bytes(b"BM")
    rows, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.shuffle.partitions")
    limit = spark.conf.get(rows)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        query = stream_standardize(file_stream(spark, str(source)), out, str(tmp_path / "s"))
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert query.exception() is None and spark.conf.get(rows) == limit
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == sorted(f"f{n}.bmp" for n in range(120))
    alive = [int(x) for x in open(log).read().split()]
    assert len(alive) == 120 and max(alive) < 60


def made(spark, out):
    read = spark.read.parquet(str(out)).selectExpr("name", "cast(batch AS INT) AS batch")
    return sorted((r["batch"], r["name"]) for r in read.collect())


def test_the_driver_holds_a_log_and_not_the_files_of_a_stream(spark, tmp_path):
    """Spark's file source lists and remembers on the driver what its checkpoint names: that may not be every image."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    listings = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    found = listings.getCount()
    for wave in (range(150), range(150, 220)):
        for n in wave:
            (source / f"f{n}.bmp").write_bytes(b"BM")
        for _ in range(2):  # nothing new: no batch
            query = stream_standardize(file_stream(spark, str(source)), str(out), str(tmp_path / "s"))
            query.awaitTermination()
            assert query.exception() is None
    assert listings.getCount() - found < 150  # some 20 of each run's own tables
    assert made(spark, out) == sorted((int(n >= 150), f"f{n}.bmp") for n in range(220))
    seen = [p.read_text().count('"path"') for p in (tmp_path / "s" / "sources" / "0").iterdir() if not p.name.startswith(".")]
    assert seen == [1, 1]


def test_a_stream_takes_the_oldest_files_first_in_bounded_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(standardize, "LOG_ROWS", 3, raising=False)
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for n in range(20):
        (source / f"f{n:02}.bmp").write_bytes(b"BM")
        os.utime(source / f"f{n:02}.bmp", (1_700_000_000 - 60 * n,) * 2)
    stream_standardize(file_stream(spark, str(source), 6), str(out), str(tmp_path / "s")).awaitTermination()
    rows = made(spark, out)
    assert [name for _, name in sorted(rows, key=lambda r: (r[0], [-ord(c) for c in r[1]]))] == [f"f{n:02}.bmp" for n in range(19, -1, -1)]
    assert max(sum(b == batch for b, _ in rows) for batch, _ in rows) <= 6


def test_a_stream_takes_the_files_that_the_file_source_takes(spark, tmp_path):
    """Hidden and empty files and plain folders are passed over; those of partitions, and patterns of files, are taken."""
    plain, parts, images = tmp_path / "plain", tmp_path / "parts", list(IMAGES)
    put(plain, images[:2])
    put(plain / "below", images[2:3])
    for name in ("_hidden.bmp", ".hidden.bmp", "note.txt"):
        (plain / name).write_bytes(b"BM")
    (plain / "empty.bmp").write_bytes(b"")
    put(parts / "k=1", images[2:3])
    put(parts / "k=2", images[3:4])
    put(parts / "_k", images[4:5])
    for n, (pattern, want) in enumerate([(plain, images[:2]), (parts, images[2:4]), (tmp_path / "p[k-m]a*", images[:2]), (plain / "*0.bmp", images[:1])]):
        query = stream_standardize(file_stream(spark, str(pattern)), str(tmp_path / f"out{n}"), str(tmp_path / f"s{n}"))
        query.awaitTermination()
        assert query.exception() is None
        assert made(spark, tmp_path / f"out{n}") == [(0, name) for name in want]


def test_stream_starts_again_after_a_first_batch_that_broke_off(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    put(source, ["i0.bmp"])
    (out / "batch=0" / "_temporary" / "0").mkdir(parents=True)
    query = stream_standardize(file_stream(spark, str(source)), str(out), str(tmp_path / "s"))
    query.awaitTermination()
    assert query.exception() is None
    assert [r["name"] for r in spark.read.parquet(str(out)).collect()] == ["i0.bmp"]


def test_rests_of_writes_are_neither_outputs_nor_archived(spark, tmp_path):
    put(tmp_path / "images", ["i0.bmp"])
    out = tmp_path / "images_standardized"
    out.mkdir()
    (out / "._partial.i0.bmp.9").write_bytes(b"half")
    put(tmp_path, [])
    with zipfile.ZipFile(tmp_path / "images.zip", "w") as archive:
        archive.writestr("i1.bmp", codec.encode_bmp(IMAGES["i1.bmp"]))
    assert counts(spark, tmp_path) == {"processed": 2}
    packed = [n for p in (tmp_path / "images_standardized_zip").glob("*.zip") for n in zipfile.ZipFile(p).namelist()]
    assert sorted(packed) == ["i0.bmp", "i1.bmp"]


def test_stream_writes_dead_letters_and_counters(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, ["i0.bmp"])
    (source / "bad.bmp").write_bytes(b"BM")
    tables = {"letters": str(tmp_path / "letters"), "counters": str(tmp_path / "counters")}
    for state in ("s", "s", "t"):  # the last one has lost its state: the failed file is tried again
        stream_standardize(file_stream(spark, str(source)), out, str(tmp_path / state), **tables).awaitTermination()
    letters = spark.read.parquet(tables["letters"]).collect()
    assert {(r["image_name"], r["stage"]) for r in letters} == {("bad.bmp", "process")} and all(r["error"] for r in letters)
    counted = sorted((r["batch"], r["status"], r["images"]) for r in spark.read.parquet(tables["counters"]).collect())
    assert counted == [(0, "failed", 1), (0, "processed", 1)]
    put(source, ["i1.bmp", "i2.bmp"])
    stream_standardize(file_stream(spark, str(source)), out, str(tmp_path / "s"), **tables).awaitTermination()
    later = spark.read.parquet(tables["counters"]).filter("batch = 1").collect()
    assert [(r["status"], r["images"]) for r in later] == [("processed", 2)]
