from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from tidepool.operators import quality
from tidepool.operators.load import Warehouse


def test_not_null_single_pass_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, b string")
    rows = {r.column_name: r.failures for r in quality.not_null(df, "t", ["a", "b"]).collect()}
    assert rows == {"a": 1, "b": 2}


def test_unique_counts_duplicated_keys_ignoring_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (3,), (3,)], "k long")
    assert quality.unique(df, "t", "k").first().failures == 2


def test_build_stops_before_dependents(spark):
    built = []

    def raw(_):
        built.append("raw")
        return spark.createDataFrame([(1,), (None,)], "id long")

    def model(models):
        built.append("model")
        return models["raw"]

    steps = [
        quality.BuildStep("raw", raw, quality.ModelTests("raw", not_null=("id",))),
        quality.BuildStep("model", model, quality.ModelTests("model", unique=("id",))),
    ]
    with pytest.raises(quality.DataTestFailure, match=r"not_null\(raw.id\)=1"):
        quality.run_build(steps)
    assert built == ["raw"]
    report = quality.run_build(steps, fail_fast=False)
    assert [(r["test"], r["passed"]) for r in report.results] == [("not_null", False), ("unique", True)]


def test_project_build_stops_on_failing_source(spark):
    from tidepool.plans.build import build_project

    customers = spark.createDataFrame([(None, "x", "s")], "customer_id long, name string, segment string")
    events = spark.createDataFrame([], "event_id long, customer_id long, event_name string, occurred_at timestamp_ntz")
    orders = spark.createDataFrame([], "order_id long, customer_id long, amount double, ordered_at string")
    with pytest.raises(quality.DataTestFailure, match="customers.customer_id"):
        build_project({"customers": customers, "events": events, "orders": orders})


def test_unique_in_buckets(spark, tmp_path):
    schema = "a long, `b c` string, v long"
    rows = [(i, str(i % 3), i) for i in range(400)]
    wh = Warehouse(spark, str(tmp_path), buckets=8, file_rows=20)
    wh.load(spark.createDataFrame(rows, schema), "d", "t", "merge", primary_key=["a", "b c"])

    def run(table="t"):
        return quality.unique_in_buckets(wh, "d", table).first()

    assert (run().failures, run().column_name) == (0, "a,b c")
    assert run().buckets_read == 0  # nothing has changed
    # one key twice (in another file than its first row), one three times, NULLs, a new key
    more = [(5, "2", 0), (7, "1", 0), (7, "1", 1), (None, "1", 0), (None, "1", 0), (9, None, 0), (9, None, 1), (1000, "0", 0)]
    wh.load(spark.createDataFrame(more, schema), "d", "t", "append")
    seen = run()
    assert seen.failures == 2 and 1 <= seen.buckets_read <= 6
    brute = wh.read("d", "t").dropna(subset=["a", "`b c`"]).groupBy("a", "b c").count().where("count > 1").count()
    assert brute == 2
    wh.load(spark.createDataFrame([(5, "2", 9)], schema), "d", "t", "delete_insert")
    seen = run()
    assert (seen.failures, seen.buckets_read) == (1, 1)
    wh.load(spark.createDataFrame([(1, "x", 1), (1, "x", 2)], schema), "d", "t", "replace", ["a", "b c"])
    assert run().failures == 1  # a new version: nothing known holds
    # a table without buckets takes the shuffled way; an empty one has no failures
    wh.buckets = None
    wh.load(spark.createDataFrame(more, schema), "d", "flat", "replace", primary_key=["a", "b c"])
    assert (run("flat").failures, run("flat").buckets_read) == (1, None)
    wh.load(spark.createDataFrame([], schema), "d", "none", "merge", primary_key=["a"], buckets=4)
    assert run("none").failures == 0
    with pytest.raises(ValueError, match="no key"):
        run("absent")


def test_unique_in_buckets_has_no_exchange(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), buckets=8)
    wh.load(spark.range(500).withColumn("v", F.lit("x")), "d", "t", "merge", primary_key=["id"])
    st = wh.state("d", "t")
    groups = quality._bucket_groups({f.bucket: [f] for f in st.files.values()}, 1, 8)
    df = quality.duplicates_by_bucket(wh, st, groups)
    assert len(groups) == 8 and df.count() == 8
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<id:bigint>" in plan
