import hashlib

import pytest

from rasterloom.operators import audit, metadata
from rasterloom.operators.sampling import eval_sample
from rasterloom.plans import work

MAPPING = "src_ord long, artikelnummer string, image_name string"
DISK = "dir string, name string, size_bytes long"


def values(df):
    return sorted(r["value"] for r in df.collect())


@pytest.mark.parametrize(
    "left, right",
    [([], []), (["a", "b", "a"], ["b", "a"]), (["a"], ["b"]), (["a", "b", "b", "b"], ["b", "c", "c"])],
)
def test_set_identities(spark, left, right):
    def table(items):
        return spark.createDataFrame([(i,) for i in items], "x string")

    tagged = audit.tag_sets(table(left), table(right))
    assert values(audit.left_only(tagged)) == sorted(set(left) - set(right))
    assert values(audit.right_only(tagged)) == sorted(set(right) - set(left))
    assert values(audit.matched(tagged)) == sorted(set(left) & set(right))


def test_summary_and_report(spark):
    mapping = spark.createDataFrame(
        [(0, "1", "a"), (1, " 2", "nan"), (2, "3", " "), (3, "4", "b.png"), (4, None, "c"), (5, "5", None)], MAPPING
    )
    scores = spark.createDataFrame([("1", 0.5), ("2", 0.1), (None, 0.2)], "artikelnummer string, typicality double")
    disk = spark.createDataFrame([("images", "a.jpg", 0), ("images", "x.PNG", 1), ("images", "y.webp", 1)], DISK)
    ids, files = audit.tagged_ids(mapping, scores), audit.tagged_files(mapping, disk)
    row = audit.audit_summary(ids, files).first().asDict()
    assert row == {
        "ids_mapping": 4, "ids_typicality": 2, "ids_only_mapping": 3, "ids_only_typicality": 1,
        "files_expected": 2, "files_on_disk": 2, "files_matched": 1, "files_missing": 1, "files_extra": 1,
    }
    stripped = audit.audit_summary(audit.tagged_ids(mapping, scores, strip_keys=True), files).first()
    assert (stripped["ids_only_mapping"], stripped["ids_only_typicality"]) == (2, 0)
    report = {(r["category"][0], r["value"]) for r in audit.audit_report(ids, files).collect()}
    assert report == {("1", "b.png"), ("2", "x.PNG"), ("3", " 2"), ("3", "3"), ("3", "4"), ("4", "2")}
    empty = audit.audit_summary(ids.filter("false"), files.filter("false")).first()
    assert set(empty) == {0}


def test_existence(spark):
    mapping = spark.createDataFrame([(0, "1", "a"), (1, "1 ", None), (2, "2", "b.png"), (3, "3", "c")], MAPPING)
    scores = spark.createDataFrame(
        [(0, "1", 0.5), (1, "1", 0.6), (2, "2", 0.1)], "src_ord long, artikelnummer string, typicality double"
    )
    disk = spark.createDataFrame([("images", "a.jpg", 0), ("images", "a.jpg", 3)], DISK)
    marked = metadata.master_table(mapping, scores, disk)
    got = sorted((r["src_ord"], r["image_name_formatted"], r["existe_en_disco"]) for r in marked.collect())
    assert got == [(0, "a.jpg", True), (0, "a.jpg", True), (1, "", False), (1, "", False), (2, "b.png", False)]
    assert tuple(metadata.existence_summary(mapping, scores, disk).first()) == (5, 2, 3)
    assert metadata.missing_rows(marked).columns == ["artikelnummer", "image_name", "typicality"]
    none = metadata.existence_summary(mapping.filter("false"), scores, disk).first()
    assert tuple(none) == (0, 0, 0)


def test_sample_is_the_same_at_any_partitioning(spark):
    names = [f"img_{i}.jpg" for i in range(90)]
    want = sorted(names, key=lambda n: (hashlib.md5(f"{n}#42".encode()).hexdigest(), n))[:20]
    for parts in (1, 3, 8):
        table = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts)
        assert [r[0] for r in eval_sample(table).collect()] == want
    assert eval_sample(table.limit(7)).count() == 7


def test_plan_gives_each_row_one_status(spark):
    table = spark.createDataFrame([(f"{c}.jpg", c) for c in "abcde"], "image_name string, artikelnummer string")
    disk = spark.createDataFrame(
        [("base", "a.jpg", 1), ("samples", "a.jpg", 1), ("elsewhere", "b.jpg", 1), ("Samples", "c.jpg", 0), ("images", "d.jpg", 1)],
        DISK,
    )
    done = spark.createDataFrame([("d.jpg", 9), ("c.jpg", 0), ("zz.jpg", 1)], "name string, size_bytes long")
    folders = work.search_order("images")
    plan = {r["image_name"]: r for r in work.work_plan(table, disk, done, folders).collect()}
    assert {n: r["status"] for n, r in plan.items()} == {
        "a.jpg": "todo", "b.jpg": "missing", "c.jpg": "todo", "d.jpg": "skipped", "e.jpg": "missing",
    }
    assert plan["a.jpg"]["input_path"] == "samples/a.jpg"
    assert plan["a.jpg"]["target"] == "images_standardized/a.jpg"
    left = work.pending(table, done)
    assert sorted(r["image_name"] for r in left.collect()) == ["a.jpg", "b.jpg", "c.jpg", "e.jpg"]
    assert work.pending(left, done).count() == 4
    assert work.local_samples(table, None) is table
    assert work.local_samples(table, disk).count() == 4
    located = {r["image_name"]: r["input_path"] for r in work.locate(table, disk, folders).collect()}
    assert located["c.jpg"] == "Samples/c.jpg" and located["e.jpg"] is None


def test_union_after_ingest(spark):
    disk = spark.createDataFrame([("images", "old.jpg", 1), ("images", "n.txt", 1)], DISK)
    members = spark.createDataFrame([("new.bmp",), ("old.jpg",)], "name string")
    assert sorted(r[0] for r in work.ingest_union(disk, members).collect()) == ["new.bmp", "old.jpg"]


def test_audit_job(spark, tmp_path):
    from rasterloom.plans.audit import AuditOptions, audit

    (tmp_path / "images").mkdir()
    for name in ("a.jpg", "extra.png", "note.txt"):
        (tmp_path / "images" / name).write_bytes(b"x")
    (tmp_path / "m.csv").write_text("artikelnummer,image_name\n1,a\n2,b.png\n3,nan\n4,c\n")
    (tmp_path / "t.csv").write_text("artikelnummer,typicality,\n1,0.5,x\n2,0.7,\n2,0.8,\n9,1,\n")
    row = audit(spark, AuditOptions(str(tmp_path), "m.csv", "t.csv")).first().asDict()
    assert (row["files_expected"], row["files_on_disk"], row["files_matched"], row["files_missing"], row["files_extra"]) == (3, 2, 1, 2, 1)
    assert (row["rows_total"], row["rows_found"], row["rows_missing"]) == (3, 1, 2)
    master = spark.read.option("header", True).csv(str(tmp_path / "audit" / "master"))
    assert master.count() == 3 and {"typicality", "existe_en_disco", "image_name_formatted"} <= set(master.columns)
    missing = spark.read.option("header", True).csv(str(tmp_path / "audit" / "missing")).collect()
    assert sorted(r["typicality"] for r in missing) == ["0.7", "0.8"]
    lists = spark.read.text(str(tmp_path / "audit" / "reports")).collect()
    assert {r["value"] for r in lists if r["category"].startswith("1_")} == {"b.png", "c.jpg"}
    assert {r["category"][0]: r["value"] for r in lists if r["category"][0] in "24"} == {"2": "extra.png", "4": "9"}
