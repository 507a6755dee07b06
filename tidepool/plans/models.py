"""Staging views and the ``customer_activity`` mart.

Staging models are lazy DataFrames (views): a projection plus casts that Catalyst
inlines into the scans.  The mart aggregates events and orders per customer *before*
joining them to customers -- Catalyst does not push aggregates below outer joins, so
the eager aggregation is written by hand.  After aggregation each right side has at
most one row per key, so the two left joins cannot fan out, and both are hash
partitioned on ``customer_id`` already: only the customers side is exchanged for the
joins (or AQE turns them into broadcasts when the runtime size is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidepool.functions.casts import to_decimal, to_int64, to_string, zero_if_null
from tidepool.functions.datetime import parse_datetime_best_effort

MONEY = DecimalType(18, 2)

MART_COLUMNS = (
    "customer_id",
    "name",
    "segment",
    "event_count",
    "last_event_at",
    "order_count",
    "lifetime_value",
    "last_order_at",
)


def stg_customers(customers: DataFrame) -> DataFrame:
    cols = [to_int64("customer_id").alias("customer_id"), F.col("name"), F.col("segment")]
    if "created_at" in customers.columns:
        cols.append(F.col("created_at"))
    return customers.select(*cols)


def stg_events(events: DataFrame) -> DataFrame:
    return events.select(
        to_int64("event_id").alias("event_id"),
        to_int64("customer_id").alias("customer_id"),
        F.col("event_name"),
        F.col("occurred_at"),
    )


def stg_orders(orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    ordered_type = orders.schema["ordered_at"].dataType
    if ordered_type.typeName() == "string":
        ordered_at = parse_datetime_best_effort(to_string("ordered_at"))
    else:  # typed already: no per-row string round trip, same result
        ordered_at = parse_datetime_best_effort("ordered_at", ordered_type)
    return orders.select(
        to_int64("order_id").alias("order_id"),
        to_int64("customer_id").alias("customer_id"),
        to_decimal("amount").alias("amount"),
        ordered_at.alias("ordered_at"),
        *[F.col(c) for c in extra],
    )


def events_by_customer(events: DataFrame) -> DataFrame:
    """count() and max(ts) per customer; partial aggregation absorbs hot customers."""
    return events.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max("occurred_at").alias("last_event_at"),
    )


def orders_by_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount").alias("lifetime_value"),
        F.max("ordered_at").alias("last_order_at"),
    )


def customer_activity(
    customers: DataFrame, events: DataFrame, orders: DataFrame
) -> DataFrame:
    """One row per customer: activity and order metrics from staged inputs."""
    ev = events_by_customer(events)
    od = orders_by_customer(orders)
    joined = customers.join(ev, "customer_id", "left").join(od, "customer_id", "left")
    ltv_type = od.schema["lifetime_value"].dataType
    return joined.select(
        F.col("customer_id"),
        F.col("name"),
        F.col("segment"),
        zero_if_null("event_count").alias("event_count"),
        F.col("last_event_at"),
        zero_if_null("order_count").alias("order_count"),
        zero_if_null("lifetime_value", F.lit(0).cast(MONEY)).cast(ltv_type).alias(
            "lifetime_value"
        ),
        F.col("last_order_at"),
    )


def build_mart(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw tables -> staging -> mart, all lazy."""
    return customer_activity(
        stg_customers(raw["customers"]),
        stg_events(raw["events"]),
        stg_orders(raw["orders"]),
    )


def register_views(spark, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging models and the mart as temp views (``stg_customers``, ``stg_events``,
    ``stg_orders``, ``customer_activity``) for SQL users; all stay lazy."""
    views = {
        "stg_customers": stg_customers(raw["customers"]),
        "stg_events": stg_events(raw["events"]),
        "stg_orders": stg_orders(raw["orders"]),
    }
    views["customer_activity"] = customer_activity(
        views["stg_customers"], views["stg_events"], views["stg_orders"]
    )
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
