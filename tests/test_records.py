"""Records of split files against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from rasterloom.sources import records, tables


def scanned(spark, path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        table = tables.scan_csv(spark, path)
        rows = table.orderBy("src_ord").drop("src_ord").collect()
        return [tuple(r) for r in rows], records._lines(spark, path).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def text(seed, n):
    drawn = random.Random(seed)
    cells = ["a", "", "é", 'say "x"', "two\nlines", "x,y", 'a "b", c\n\n"d"', "7", " pad ", "\n" * 30 + "deep", '"', '""', "x\n" * 60]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=drawn.choice(["\n", "\r\n"]))
    writer.writerow(["k", "v", "w"])
    writer.writerows([[f"k{i}", *drawn.choices(cells, [9, 2, 3, 1, 1, 1, 1, 5, 1, 0.3, 0.5, 0.5, 0.3], k=2)] for i in range(n)])
    return out.getvalue()


@pytest.mark.parametrize(("seed", "split"), [(1, 64), (2, 200), (3, 1000), (4, 1 << 20)])
def test_against_csv_module(spark, tmp_path, seed, split):
    body = text(seed, 300)
    (tmp_path / "m.csv").write_bytes(body.encode())
    got, tasks = scanned(spark, str(tmp_path / "m.csv"), split)
    want = [tuple(c.replace("\r\n", "\n") or None for c in r) for r in csv.reader(io.StringIO(body, newline=""))][1:]
    assert got == want
    assert tasks > len(body) / split / 2


def test_files_of_a_folder_keep_their_headers_apart(spark, tmp_path):
    bodies = [text(seed, 60) for seed in (5, 6, 7)]
    for i, body in enumerate(bodies):
        (tmp_path / f"part-{i}.csv").write_bytes(body.encode())
    got, _ = scanned(spark, str(tmp_path), 150)
    want = [tuple(c.replace("\r\n", "\n") or None for c in r) for b in bodies for r in list(csv.reader(io.StringIO(b, newline="")))[1:]]
    assert got == want


def test_a_stray_quote_changes_no_other_row(spark, tmp_path):
    lines = [f"{i},img {i}.jpg" for i in range(200)]
    lines[70] = '70,5" pipe.jpg'
    (tmp_path / "m.csv").write_text("k,v\n" + "\n".join(lines) + "\n")
    got, tasks = scanned(spark, str(tmp_path / "m.csv"), 100)
    assert got == [tuple(line.split(",")) for line in lines] and tasks > 10


def test_an_open_field_takes_the_rest_of_its_file_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,x\n2,"open\n3,y\n4,z\n')
    (tmp_path / "b.csv").write_text("k,v\n5,x\n")
    for split in (4, 1000):
        assert scanned(spark, str(tmp_path), split)[0] == [("1", "x"), ("2", "open\n3,y\n4,z"), ("5", "x")]


@pytest.mark.parametrize("line", ['a,"b', '"', '"a"b,"c', 'x"y', '""', '"""', '"a""', '"a"",', "", ",", '",",'])
@pytest.mark.parametrize("inside", [False, True])
def test_ends_inside_like_the_csv_module(line, inside):
    """Open at the end: a further line goes on in the same record."""
    rows = list(csv.reader(io.StringIO(('"' if inside else "") + line + "\nnext\n", newline="")))
    assert records.ends_inside(line, inside) == (len(rows) == 1)


def test_blank_files_and_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("k,v\n\n1,x\n\n")
    assert scanned(spark, str(tmp_path / "m.csv"), 1000)[0] == [("1", "x")]
    (tmp_path / "n.csv").write_text("k,v\n")
    assert tables.scan_csv(spark, str(tmp_path / "n.csv")).collect() == []
    assert tables.scan_csv(spark, str(tmp_path / "n.csv")).where(F.col("k") == "1").count() == 0
