from collections import Counter

import pytest
from pyspark.sql import functions as F

from rasterloom.operators import joins
from rasterloom.operators.metadata import master_table, merge_metadata


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("k"),
        F.col("id").alias("row"),
    )


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_hot_keys_names_just_the_hot_one(skewed):
    hot = joins.hot_keys(skewed, "k")
    assert list(hot) == ["hot"] and hot["hot"][0] >= 1000 and hot["hot"][1] >= 2
    assert joins.hot_keys(skewed.filter("row < 0"), "k") == {}


def test_attach_spreads_a_hot_key_and_changes_no_row(spark, skewed):
    lookup = spark.range(500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    lookup = lookup.union(spark.createDataFrame([("hot", -1)], "k string, v long"))
    for how in ("left", "inner"):
        assert rows(joins.attach(skewed, lookup, "k", ["row"], how)) == rows(skewed.join(lookup, "k", how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joins.attach(skewed, lookup, "k", ["row"]).filter("k = 'hot'")
        assert parts.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("hot_side", ["left", "right", "both", "none"])
def test_inner_pairs_equals_a_plain_join(spark, hot_side):
    def side(name, hot, n):
        key = F.when((F.col("id") % 3 == 0) & F.lit(hot), "hot").otherwise((F.col("id") % 50).cast("string"))
        return spark.range(n).select(key.alias("k"), F.col("id").alias(name)).union(
            spark.createDataFrame([("hot", -1), ("hot", -2)], f"k string, {name} long")
        )

    left = side("a", hot_side in ("left", "both"), 300)
    right = side("b", hot_side in ("right", "both"), 200)
    got = joins.inner_pairs(left, right, "k", ["a"], ["b"])
    assert rows(got) == rows(left.join(right, "k"))


def test_first_per_and_position_do_not_depend_on_partitions(spark):
    base = spark.range(500).select((F.col("id") * 100_003 % 7_000_000_000).alias("o"), (F.col("id") % 37).alias("k"))
    want = None
    for parts in (1, 3, 8):
        df = base.repartition(parts)
        kept = rows(joins.first_per(df, "k", [F.col("o")]))
        placed = joins.with_position(df, [F.col("o")]).orderBy("o").select("position").collect()
        assert [r[0] for r in placed] == list(range(500))
        assert want is None or kept == want
        want = kept
    assert len(want) == 37


@pytest.mark.parametrize("n, k, sizes", [(5, 4, [2, 2, 1]), (0, 4, []), (3, 8, [1, 1, 1]), (100, 6, [17] * 5 + [15])])
def test_chunks(spark, n, k, sizes):
    got = joins.chunk_plan(spark.range(n), k, [F.col("id")]).orderBy("id").collect()
    counts = Counter(r["chunk"] for r in got)
    assert [counts[c] for c in sorted(counts)] == sizes
    assert [r["chunk"] for r in got] == sorted(r["chunk"] for r in got)
    with pytest.raises(ValueError):
        joins.chunk_plan(spark.range(1), 0, [F.col("id")])


def test_cap(spark):
    df = spark.range(9)
    order = [F.col("id")]
    assert joins.cap(df, None, order).count() == joins.cap(df, 0, order).count() == 9
    assert [r[0] for r in joins.cap(df, 5, order).collect()] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        joins.cap(df, -1, order)


MAPPING = [(0, None, "a"), (1, " 1", "b.jpg "), (2, "2", "b"), (3, "3", None), (4, "1", " "), (5, "9", "c.png")]
SCORES = [(0, "1", 0.5), (1, "1 ", 0.7), (2, None, 0.9), (3, "4", 0.1), (4, "2", 0.2)]


def tables(spark):
    return (
        spark.createDataFrame(MAPPING, "src_ord long, artikelnummer string, image_name string"),
        spark.createDataFrame(SCORES, "src_ord long, artikelnummer string, typicality double"),
    )


def test_merge_keeps_the_first_row_and_the_first_score(spark):
    mapping, scores = tables(spark)
    got = merge_metadata(mapping, scores).select("src_ord", "artikelnummer", "image_name", "typicality")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "1", "b.jpg", 0.5), (5, "9", "c.png", None)]
    literal = merge_metadata(mapping, scores, null_key="literal").filter("src_ord = 0").first()
    assert (literal["artikelnummer"], literal["image_name"], literal["typicality"]) == ("nan", "a.jpg", 0.9)


def test_overlapping_columns_get_suffixes(spark):
    mapping, scores = tables(spark)
    left, right = mapping.withColumn("note", F.lit("l")), scores.withColumn("note", F.lit("r"))
    assert {"note_x", "note_y"} <= set(merge_metadata(left, right).columns)
    assert {"note_x", "note_y"} <= set(master_table(left, right).columns)


def test_master_keeps_multiplicity_and_null_names(spark):
    mapping, scores = tables(spark)
    got = master_table(mapping, scores).select("src_ord", "typicality_ord", "image_name")
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 0, "b.jpg "), (1, 1, "b.jpg "), (2, 4, "b"), (4, 0, " "), (4, 1, " "),
    ]


def test_skewed_merge_equals_a_plain_one(spark):
    """A third of the articles and a third of the names are the same."""
    mapping = spark.range(600).select(
        F.col("id").alias("src_ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 90).cast("string")).alias("artikelnummer"),
        F.when(F.col("id") % 3 == 1, "same").otherwise((F.col("id") % 200).cast("string")).alias("image_name"),
    )
    scores = spark.range(300).select(
        F.col("id").alias("src_ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 80).cast("string")).alias("artikelnummer"),
        F.col("id").cast("double").alias("typicality"),
    )
    left, right = mapping.toPandas(), scores.toPandas().drop(columns="src_ord")
    left["image_name"] += ".jpg"
    plain = left.merge(right, on="artikelnummer", how="left").drop_duplicates("image_name")
    want = {(r.src_ord, r.artikelnummer, r.image_name, None if r.typicality != r.typicality else r.typicality) for r in plain.itertuples()}
    merged = merge_metadata(mapping, scores).select("src_ord", "artikelnummer", "image_name", "typicality")
    assert {tuple(r) for r in merged.collect()} == want
    assert master_table(mapping, scores).count() == len(left.merge(right, on="artikelnummer"))


def test_chunks_of_a_scanned_csv(spark, tmp_path):
    from rasterloom.sources.tables import scan_csv

    for part in range(3):
        lines = ["name", *(f"{part}-{i:03d}" for i in range(50 + part))]
        (tmp_path / f"p{part}.csv").write_text("\n".join(lines) + "\n")
    placed = joins.chunk_plan(scan_csv(spark, str(tmp_path)), 4, [F.col("src_ord")]).collect()
    want = [f"{part}-{i:03d}" for part in range(3) for i in range(50 + part)]
    assert [r["name"] for r in sorted(placed, key=lambda r: r["position"])] == want
    assert Counter(r["chunk"] for r in placed) == {0: 39, 1: 39, 2: 39, 3: 36}


def test_many_hot_keys_are_all_found(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        rows = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id") % 300).alias("key"))
        assert len(joins.hot_keys(rows, "key")) == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
