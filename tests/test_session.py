from types import SimpleNamespace

import pytest

from rasterloom.session import qualified, shared_dir, stored


def test_shared_folder_is_the_one_the_cluster_names(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    if base:
        assert first.startswith(qualified(spark, base))


def test_a_cluster_without_shared_folder_is_refused():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: None),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster, "x")


def test_stored_tables_keep_schema_and_rows_even_if_empty(spark):
    for rows in ([], [(1, "a", b"x"), (None, None, None)]):
        table = spark.createDataFrame(rows, "i long, s string, b binary")
        back = stored(table, "t")
        assert back.schema == table.schema
        assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))
