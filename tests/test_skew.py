"""Hot keys and NULL-heavy keys: results stay whole and exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import quality
from tidepool.plans import models


def test_mart_with_hot_and_null_customers(spark):
    n = 30_000
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        # a third of all events on customer 1, a third without a customer, the rest spread
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 50 + 2)
        .cast("bigint")
        .alias("customer_id"),
        F.lit("view").alias("event_name"),
        F.expr("TIMESTAMP_NTZ'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("occurred_at"),
    )
    customers = spark.range(1, 52).select(
        F.col("id").alias("customer_id"), F.lit("c").alias("name"), F.lit("s").alias("segment")
    )
    orders = spark.createDataFrame([], "order_id long, customer_id long, amount double, ordered_at string")
    mart = models.build_mart({"customers": customers, "events": events, "orders": orders})
    got = {r.customer_id: r.event_count for r in mart.collect()}
    # brute force on the driver over a small fixture
    expected = {c: 0 for c in range(1, 52)}
    for i in range(n):
        c = 1 if i % 3 == 0 else None if i % 3 == 1 else i % 50 + 2
        if c is not None:
            expected[c] += 1
    assert got == expected
    assert got[1] == n // 3
    failing = quality.unique(models.stg_events(events), "events", "customer_id").first().failures
    assert failing == 51
