import os
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import codec
from rasterloom.functions.names import AUDIT_SUFFIXES
from rasterloom.sinks.files import copy_files, write_archives, write_files
from rasterloom.sources import archives, files, storage
from rasterloom.sources.images import decode_images, read_content, read_orientation


def folder(tmp_path, **contents):
    tmp_path.mkdir(exist_ok=True)
    for name, data in contents.items():
        (tmp_path / name.replace("__", ".")).write_bytes(data)
    return str(tmp_path)


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_listing_counts_empty_files(spark, tmp_path):
    where = folder(tmp_path / "images", a__JPG=b"1", b__png=b"", c__webp=b"22", d__txt=b"3")
    os.mkdir(os.path.join(where, "sub.jpg"))
    assert names(files.list_files(spark, {"images": where}, AUDIT_SUFFIXES)) == ["a.JPG", "b.png"]
    row = files.list_files(spark, {"x": where}).filter("name = 'c.webp'").first()
    assert (row["dir"], row["size_bytes"]) == ("x", 2)


def test_names_with_odd_characters(spark, tmp_path):
    where = folder(tmp_path / "odd dir", **{"a b+c%20#é__bmp": codec.encode_bmp(np.zeros((2, 2, 3), np.uint8))})
    listed = files.list_files(spark, {"x": where})
    assert names(listed) == ["a b+c%20#é.bmp"]
    got = read_content(listed.withColumnRenamed("path", "input_path")).first()
    assert got["status"] == "ok" and len(got["content"]) == got["size_bytes"]


def test_input_folder_choice(spark):
    rows = [("Samples", "a"), ("samples", "b"), ("other", "c"), ("samples", "d")]
    inventory = spark.createDataFrame(rows, "dir string, name string")
    choice = files.choose_input_dir(inventory)
    assert tuple(choice.first()) == ("samples", 2)
    none = inventory.filter("dir = 'other'")
    assert files.choose_input_dir(none, existing=["Samples"]).first()["dir"] == "Samples"
    assert files.choose_input_dir(none).first()["dir"] == "images"


@pytest.fixture
def archive(tmp_path):
    where = tmp_path / "in"
    where.mkdir()
    with zipfile.ZipFile(where / "b.zip", "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("images/", b"")
        out.writestr("images/x.jpg", b"")
        out.writestr("deep/er/x.jpg", b"first")
        out.writestr("images/x.jpg.bak", b"no")
        out.writestr("other/x.jpg", b"second")
        out.writestr("../out.PNG", b"traversal" * 1000)
        out.writestr("notes.txt", b"text")
        out.writestr("e1/empty.bmp", b"")
        out.writestr("e2/empty.bmp", b"")
        out.writestr("here.webp", b"already there")
        out.writestr(".jpg", b"no stem")
    with zipfile.ZipFile(where / "c.zip", "w", zipfile.ZIP_BZIP2) as out:
        out.writestr("x.jpg", b"later archive")
        out.writestr("packed.png", b"other method")
    (where / "broken.zip").write_bytes(b"not an archive")
    return str(where)


def test_zip_ingest(spark, archive):
    present = spark.createDataFrame([("here.webp", 5), ("x.jpg", 0)], "name string, size_bytes long")
    found = {r["name"]: r for r in archives.read_zip(spark, archive, existing=present).collect()}
    broken = found.pop("broken.zip")
    assert broken["status"] == "failed" and "archive_unreadable" in broken["error"]
    assert {n: bytes(r["content"]) for n, r in found.items()} == {
        "x.jpg": b"first",
        "out.PNG": b"traversal" * 1000,
        "empty.bmp": b"",
        "packed.png": b"other method",
    }
    assert found["out.PNG"]["raw_unsafe"] and not found["x.jpg"]["raw_unsafe"]
    assert found["empty.bmp"]["member"] == "e2/empty.bmp"
    assert all(r["status"] == "ok" for r in found.values())


def test_unreadable_archives_and_members_become_rows(spark, archive):
    index = archives.index_archives(spark, archive)
    bad = index.filter("error is not null").collect()
    assert [r["archive"] for r in bad] == ["broken.zip"] and "archive_unreadable" in bad[0]["error"]
    path = os.path.join(archive, "b.zip")
    data = bytearray(open(path, "rb").read())
    at = data.index(b"deep/er/x.jpg") + len("deep/er/x.jpg")
    data[at] ^= 0xFF
    open(path, "wb").write(data)
    rows = {r["member"]: r for r in archives.read_zip(spark, archive).collect()}
    assert rows["deep/er/x.jpg"]["status"] == "failed"
    assert "member_unreadable" in rows["deep/er/x.jpg"]["error"]
    assert rows["../out.PNG"]["status"] == "ok"


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as out:
        for i in range(200):
            out.writestr(f"i/{i:03d}.jpg", bytes([i]) * 50)
    found = archives.read_zip(spark, str(tmp_path), partitions=5)
    assert found.rdd.getNumPartitions() == 5
    sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 200 and max(sizes) < 100
    assert all(bytes(r["content"]) == bytes([int(r["name"][:3])]) * 50 for r in found.collect())


def test_written_files_replace_and_copies_keep_their_time(spark, tmp_path):
    out = str(tmp_path / "out")
    for text in (b"old", b"new!"):
        table = spark.createDataFrame([("a.bin", bytearray(text)), ("b.bin", None)], "name string, content binary")
        manifest = {r["name"]: r for r in write_files(table, out).collect()}
    assert (manifest["a.bin"]["size_bytes"], manifest["b.bin"]["size_bytes"]) == (4, 0)
    assert sorted(os.listdir(out)) == ["a.bin", "b.bin"]
    os.utime(os.path.join(out, "a.bin"), (1_000_000_000, 1_000_000_000))
    rows = [("a.bin", f"file:{out}/a.bin"), ("gone.bin", f"file:{out}/gone.bin")]
    copied = copy_files(spark.createDataFrame(rows, "name string, path string"), str(tmp_path / "copy"))
    assert {r["name"]: r["status"] for r in copied.collect()} == {"a.bin": "copied", "gone.bin": "missing"}
    assert os.stat(tmp_path / "copy" / "a.bin").st_mtime == 1_000_000_000
    assert os.listdir(tmp_path / "copy") == ["a.bin"]


def test_archives_roll_over_and_hold_everything(spark, tmp_path):
    rows = [(f"{i}.jpg", bytearray([i]) * 100) for i in range(50)]
    table = spark.createDataFrame(rows, "name string, content binary").repartition(3)
    manifest = write_archives(table, str(tmp_path / "z"), max_bytes=500)
    made = sorted((tmp_path / "z").glob("*.zip"))
    assert len(made) >= 10 and manifest.count() == 50
    seen = {}
    for path in made:
        with zipfile.ZipFile(path) as opened:
            assert sum(m.file_size for m in opened.infolist()) <= 500
            seen |= {n: opened.read(n) for n in opened.namelist()}
    assert seen == {n: bytes(c) for n, c in rows}


def test_decoding_keeps_broken_files_as_rows(spark, tmp_path):
    img = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    where = folder(tmp_path / "d", **{"ok  1__bmp": codec.encode_bmp(img), "bad__png": b"nothing", "empty__jpg": b""})
    found = decode_images(spark, where)
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {r["name"]: r for r in found.collect()}
    assert len(rows) == 3 and rows["empty.jpg"]["image"] is None
    assert (rows["empty.jpg"]["status"], rows["empty.jpg"]["error"]) == ("failed", "empty_file")
    assert (rows["bad.png"]["status"], rows["bad.png"]["error"]) == ("failed", "decode_failed")
    good = rows["ok  1.bmp"]["image"]
    assert (good["height"], good["width"]) == (2, 4)
    assert bytes(good["data"]) == img[:, :, ::-1].tobytes()


def test_camera_orientation_is_read_from_the_header(spark, tmp_path):
    def photo(order, tag):
        exif = struct.pack(order + "HI", 42, 8) + struct.pack(order + "H", 2)
        exif += struct.pack(order + "HHII", 0x010F, 2, 1, 0)
        exif += struct.pack(order + "HHIHH", 0x0112, 3, 1, tag, 0)
        body = b"Exif\0\0" + (b"II" if order == "<" else b"MM") + exif
        other = b"\xff\xe0" + struct.pack(">H", 6) + b"JFIF"
        return b"\xff\xd8" + other + b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda"

    where = folder(tmp_path / "p", a__jpg=photo("<", 6), b__jpg=photo(">", 3), c__jpg=b"\xff\xd8\xff\xda", d__png=b"x", e__jpg=b"")
    got = read_orientation(files.list_files(spark, {"p": where}))
    assert {r["name"]: r["orientation"] for r in got.collect()} == {
        "a.jpg": 6, "b.jpg": 3, "c.jpg": None, "d.png": None, "e.jpg": None,
    }


def test_jpeg_and_png_decode_with_sparks_image_source(spark, tmp_path):
    java = spark._jvm
    picture = java.java.awt.image.BufferedImage(16, 8, 5)
    for y in range(8):
        for x in range(16):
            picture.setRGB(x, y, 0xC86432)
    for kind in ("jpg", "png"):
        java.javax.imageio.ImageIO.write(picture, kind, java.java.io.File(str(tmp_path / f"a.{kind}")))
    for row in decode_images(spark, str(tmp_path)).collect():
        image = row["image"]
        assert (row["status"], image["height"], image["width"], image["nChannels"]) == ("ok", 8, 16, 3)
        pixels = np.frombuffer(image["data"], np.uint8).reshape(8, 16, 3).astype(int)
        assert np.abs(pixels - [0x32, 0x64, 0xC8]).max() <= 3


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_the_first_of_two_equal_members_wins(spark, tmp_path, method):
    with zipfile.ZipFile(tmp_path / "UPPER.ZIP", "w", method) as out, pytest.warns(UserWarning):
        out.writestr("images/a.jpg", b"first" * 99)
        out.writestr("images/b.jpg", b"")
        out.writestr("images/a.jpg", b"SECOND" * 99)
    for where in (tmp_path, tmp_path / "UPPER.ZIP"):
        rows = {r["name"]: r for r in archives.read_zip(spark, str(where)).collect()}
        assert bytes(rows["a.jpg"]["content"]) == b"first" * 99 and rows["a.jpg"]["ord"] == 0
        assert bytes(rows["b.jpg"]["content"]) == b"" and len(rows) == 2


def test_a_named_archive_is_opened_whatever_it_is_called(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "images.bundle", "w") as out:
        out.writestr("a.jpg", b"x")
    (tmp_path / "text.txt").write_bytes(b"no archive")
    found = archives.read_zip(spark, [str(tmp_path / "images.bundle"), str(tmp_path / "text.txt")]).collect()
    assert {(r["name"], r["status"]) for r in found} == {("a.jpg", "ok"), ("text.txt", "failed")}


def test_fewer_archives_leave_no_stale_ones(spark, tmp_path):
    rows = [(f"{i}.jpg", bytearray([i])) for i in range(40)]
    (tmp_path / "part-of-something.zip").write_bytes(b"not ours")
    for parts in (8, 3):
        table = spark.createDataFrame(rows, "name string, content binary").repartition(parts)
        write_archives(table, str(tmp_path))
    members = [n for p in tmp_path.glob("part-0*.zip") for n in zipfile.ZipFile(p).namelist()]
    assert sorted(members) == sorted(n for n, _ in rows) and (tmp_path / "part-of-something.zip").exists()


def test_files_that_are_not_complete_are_not_listed(spark, tmp_path):
    from rasterloom.sources import storage

    stream, finish = storage.open_replacing(f"file:{tmp_path}/sub/a.jpg", "7")
    stream.write(b"x")
    (tmp_path / "b.jpg").write_bytes(b"y")
    for recurse in (False, True):
        found = files.list_files(spark, {"f": str(tmp_path)}, recurse=recurse).collect()
        assert [r["name"] for r in found] == ["b.jpg"]
    finish()
    assert {r["name"] for r in files.list_files(spark, {"f": str(tmp_path)}, recurse=True).collect()} == {"b.jpg", "sub/a.jpg"}


def test_a_tree_is_listed_by_many_tasks(spark, tmp_path):
    for i in range(1000):
        sub = tmp_path / f"d{i % 40}" / f"s{i}"
        sub.mkdir(parents=True)
        (sub / "a.jpg").write_bytes(b"x" * (i % 7))
    (tmp_path / "output" / "deep").mkdir(parents=True)
    (tmp_path / "output" / "deep" / "done.jpg").write_bytes(b"y")
    (tmp_path / "d0" / "link").symlink_to(tmp_path, target_is_directory=True)
    (tmp_path / "top.jpg").write_bytes(b"z")
    found = files.list_files(spark, {"f": str(tmp_path)}, recurse=True, skip=["output"])
    rows = found.select("name", "size_bytes", "path", F.spark_partition_id().alias("task")).collect()
    assert {(r["name"], r["size_bytes"]) for r in rows} == {(f"d{i % 40}/s{i}/a.jpg", i % 7) for i in range(1000)} | {("top.jpg", 1)}
    assert len(rows) == 1001 and all(r["path"].endswith(f"{tmp_path.name}/{r['name']}") for r in rows)
    kept = found.inputFiles()  # what the tasks of the levels wrote
    assert len(kept) > 8


def test_a_file_that_goes_while_its_folder_is_listed_does_not_end_the_listing(tmp_path):
    for n in range(5):
        (tmp_path / f"f{n}").write_bytes(b"x")
    order = [entry.name for entry in os.scandir(tmp_path)]
    found = storage.list_folder(str(tmp_path))
    names = [next(found)[0]]
    os.remove(tmp_path / order[2])
    names += [name for name, *_ in found]
    assert names == order[:2] + order[3:]
