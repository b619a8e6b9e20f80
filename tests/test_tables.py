import pytest
from pyspark.sql import functions as F

from rasterloom.operators.joins import with_position
from rasterloom.sinks.tables import append_dead_letters, export_csv, write_reports
from rasterloom.sources import tables


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_typicality_with_a_blank_third_header(spark, tmp_path):
    path = put(tmp_path / "t.csv", "artikelnummer,typicality,\n 7 ,0.5,\n,1.5,x\nA1,,\n")
    table = tables.scan_typicality(spark, path)
    assert "_c2" in table.columns
    clean = tables.drop_artifact_columns(table)
    assert clean.columns == ["src_ord", "artikelnummer", "typicality"]
    assert [tuple(r) for r in clean.orderBy("src_ord").select("artikelnummer", "typicality").collect()] == [
        (" 7 ", 0.5), (None, 1.5), ("A1", None),
    ]
    assert tables.drop_artifact_columns(table.withColumnRenamed("_c2", "Unnamed: 2")).columns == clean.columns


def test_missing_columns_are_named(spark, tmp_path):
    path = put(tmp_path / "m.csv", "artikelnummer,name\n1,a\n")
    with pytest.raises(ValueError, match="image_name.*'name'"):
        tables.scan_mapping(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.scan_mapping(spark, str(tmp_path / "absent.csv"))


def test_null_texts_quotes_and_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "m.csv", '﻿artikelnummer,image_name\n1,NA\nnull,"a ""b"", c.jpg"\n2,""\n3, NA \n')
    got = tables.scan_mapping(spark, path).orderBy("src_ord").select("artikelnummer", "image_name").collect()
    assert [tuple(r) for r in got] == [("1", None), (None, 'a "b", c.jpg'), ("2", None), ("3", " NA ")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(tmp_path / "m.csv", 'artikelnummer,image_name\n1,"a\nb.jpg"\n2,c.jpg\n')
    got = tables.scan_mapping(spark, path, multi_line=True).orderBy("src_ord").select("image_name").collect()
    assert [r[0] for r in got] == ["a\nb.jpg", "c.jpg"]


def test_key_modes(spark, tmp_path):
    path = put(tmp_path / "m.csv", "artikelnummer,image_name\n007,a\n 7 ,b\n,c\n12,d\n")

    def keys(**options):
        got = tables.scan_mapping(spark, path, **options).orderBy("src_ord").select("artikelnummer")
        return [r[0] for r in got.collect()]

    assert keys() == ["007", " 7 ", None, "12"]
    assert keys(inferred_key="artikelnummer") == ["7", "7", None, "12"]
    mixed = put(tmp_path / "x.csv", "artikelnummer,image_name\n007,a\nA1,b\n")
    got = tables.scan_mapping(spark, mixed, inferred_key="artikelnummer").orderBy("src_ord")
    assert [r["artikelnummer"] for r in got.collect()] == ["007", "A1"]


def test_source_order_over_many_blocks_and_files(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        for part in (0, 1):
            lines = "".join(f"{part * 100 + i},img_{i}\n" for i in range(100))
            put(tmp_path / f"part-{part}.csv", "artikelnummer,image_name\n" + lines)
        table = tables.scan_mapping(spark, str(tmp_path))
        order = F.col("src_ord")
        placed = with_position(table, [order], (order["file"], order["block"])).orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["artikelnummer"] for r in placed] == [str(i) for i in range(200)]


def test_export_keeps_blanks_and_quotes(spark, tmp_path):
    rows = [("1", " a ", 0.5), ("2", 'x "y", z', None), (None, "  ", -1.0)]
    table = spark.createDataFrame(rows, "artikelnummer string, image_name string, typicality double")
    export_csv(table, str(tmp_path / "out"))
    back = tables.scan_typicality(spark, str(tmp_path / "out")).drop("src_ord")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_export_in_order(spark, tmp_path):
    table = spark.range(100).select((99 - F.col("id")).alias("o"), F.col("id").cast("string").alias("v"))
    export_csv(table, str(tmp_path / "out"), ["o"])
    parts = [p.read_text().split()[1:] for p in sorted((tmp_path / "out").glob("part-*"))]
    assert [v for part in parts for v in part] == [str(i) for i in range(99, -1, -1)]


def test_reports_are_sorted_and_only_there_when_needed(spark, tmp_path):
    rows = [("b", str(i)) for i in range(30, 10, -1)] + [("a", "z")]
    write_reports(spark.createDataFrame(rows, "category string, value string"), str(tmp_path / "r"))
    folders = sorted(p.name for p in (tmp_path / "r").iterdir() if p.is_dir())
    assert folders == ["category=a", "category=b"]
    lines = [line for part in sorted((tmp_path / "r" / "category=b").glob("part-*")) for line in part.read_text().split()]
    assert lines == sorted(v for c, v in rows if c == "b")


def test_dead_letters_are_appended(spark, tmp_path):
    rows = spark.createDataFrame([("a.jpg", "gone")], "image_name string, error string")
    for run in ("one", "two"):
        append_dead_letters(rows, str(tmp_path / "d"), run)
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.columns == ["run_id", "ts", "image_name", "artikelnummer", "stage", "error"]
    assert sorted(r["run_id"] for r in back.collect()) == ["one", "two"]


def test_line_breaks_in_quotes_are_found(spark, tmp_path):
    from rasterloom.sources.tables import scan_csv

    (tmp_path / "m.csv").write_text('artikelnummer,image_name\n1,"two\nlines"\n2,"say ""x"""\n')
    rows = scan_csv(spark, str(tmp_path / "m.csv")).collect()
    assert [(r["artikelnummer"], r["image_name"]) for r in rows] == [("1", "two\nlines"), ("2", 'say "x"')]
