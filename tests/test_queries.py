"""Every registered query against its DuckDB counterpart, and the shape of the plans."""

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from rasterloom.checks.oracles import ORACLES as SQL
from rasterloom.checks import views
from rasterloom.checks.queries import QUERIES
from rasterloom.operators import metadata
from rasterloom.operators.joins import first_per
from rasterloom.operators.metadata import clean_mapping
from rasterloom.session import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= queries().items() and SQL.items() <= oracle_sql().items()


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert {"image_name", "input_path", "target", "status"} <= set(frame.columns)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, QUERIES[name], SQL[name], SF_DIR) is None


def plan_of(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["work_plan", "mark_existing", "audit_summary", "existence_summary", "run_counters"])
def test_no_plan_needs_a_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_duplicates_are_limited_before_the_shuffle(spark):
    left, scores = views.load(spark, SF_DIR, "fx_mapping"), views.load(spark, SF_DIR, "fx_typicality")
    first = first_per(clean_mapping(left), "image_name", [F.col("src_ord"), F.col("artikelnummer")])
    for frame in (first, first_per(scores, "artikelnummer", [F.col("src_ord")])):
        assert frame._jdf.queryExecution().executedPlan().toString().count("row_number(), 1, Partial") == 1


def test_merging_reads_each_source_once(spark, monkeypatch):
    """Names are cut to one row each before the join, in one pass over the mapping; the plan holds no other."""
    kept = []
    monkeypatch.setattr(metadata, "stored", lambda df, purpose: kept.append(df) or stored(df, purpose))
    plan = plan_of(spark, "merge_metadata")
    assert plan.count("documents.parquet") == 0 and plan.count("row_number(), 1, Partial") == 1
    assert len(kept) == 1 and kept[0]._jdf.queryExecution().executedPlan().toString().count("documents.parquet") == 1


def test_work_plan_joins_on_the_partitioning_it_already_has(spark):
    plan = plan_of(spark, "work_plan")
    assert plan.count("Exchange hashpartitioning(image_name") == 1


def test_audit_needs_one_shuffle_per_comparison(spark):
    plan = plan_of(spark, "audit_summary")
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
