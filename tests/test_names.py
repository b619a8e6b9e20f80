from itertools import product
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from rasterloom.functions import names


def apply(spark, values, expression):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in table.orderBy("i").select(expression(F.col("v"))).collect()]


def test_any_suffix_rule_agrees_with_path_suffix_on_all_short_strings(spark):
    texts = ["".join(t) for n in range(1, 6) for t in product("a. /", repeat=n)]
    got = apply(spark, texts, names.default_ext_any)
    assert got == [t if PurePosixPath(t).suffix else t + ".jpg" for t in texts]


@pytest.mark.parametrize(
    "name, expected",
    [("a", "a.jpg"), ("a.b", "a.b"), ("a.", "a..jpg"), (".jpg", ".jpg.jpg"),
     ("a.b/c", "a.b/c.jpg"), ("v1.0", "v1.0"), ("x.JPG", "x.JPG")],
)
def test_any_suffix_rule(spark, name, expected):
    assert apply(spark, [name], names.default_ext_any) == [expected]


def test_image_suffix_rule(spark):
    given = [None, "a", "a.webp", "x.JPG", ".jpg", " y.png ", "nan", ""]
    expected = ["", "a.jpg", "a.webp.jpg", "x.JPG", ".jpg", "y.png", "nan.jpg", ".jpg"]
    assert apply(spark, given, names.default_ext_image) == expected


def test_strip_removes_every_kind_of_white_space(spark):
    texts = [c + "a b" + c for c in " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　"]
    texts += ["\n  ", "", "a​"]
    assert apply(spark, texts, names.strip) == [t.strip() for t in texts]


def test_null_key_modes(spark):
    assert apply(spark, [None, " 7 "], names.normalize_key) == [None, "7"]
    literal = apply(spark, [None, " 7 "], lambda c: names.normalize_key(c, "literal"))
    assert literal == ["nan", "7"]
    with pytest.raises(ValueError):
        names.normalize_key(F.lit("x"), "other")


def test_member_names(spark):
    members = ["images/a.JPG", "../b.png", "c.txt", ".jpg", "deep/er/d.webp", "x/..", "/e.bmp"]
    assert apply(spark, members, names.basename) == ["a.JPG", "b.png", "c.txt", ".jpg", "d.webp", "..", "e.bmp"]
    kept = apply(spark, members, lambda c: names.has_suffix(c, names.INGEST_SUFFIXES))
    assert kept == [True, True, False, False, True, False, True]
    assert apply(spark, members, names.raw_unsafe) == [False, True, False, False, False, True, True]


def test_suffix_agrees_with_path_suffix(spark):
    texts = ["".join(t) for n in range(1, 6) for t in product("a./", repeat=n)]
    assert apply(spark, texts, names.suffix) == [PurePosixPath(t).suffix for t in texts]
