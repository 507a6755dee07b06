"""The seven report cards over ``customer_activity`` and the report suite.

Every card takes the mart and an optional segment.  The segment predicate exists only
when a segment is given (the optional ``[[AND segment = ...]]`` clause): no
``1 = 1`` placeholder and no string interpolation.  Being a plain equality on a
grouping/scan column it is pushed below the mart's aggregates into the customer scan.

Empty inputs follow the warehouse: ``count`` -> 0, ``sum`` -> 0 (Spark's NULL is
coalesced), money is reported as double.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tidepool.functions.casts import to_float64, zero_if_null
from tidepool.session import scratch_dir


def filter_segment(mart: DataFrame, segment: str | None = None) -> DataFrame:
    if segment is None:
        return mart
    return mart.where(F.col("segment") == F.lit(segment))


def total_customers(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return filter_segment(mart, segment).agg(F.count(F.lit(1)).alias("customers"))


def active_customers(mart: DataFrame, segment: str | None = None) -> DataFrame:
    active = (F.col("order_count") > 0) | (F.col("event_count") > 0)
    return filter_segment(mart, segment).agg(F.count_if(active).alias("active_customers"))


def total_orders(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return filter_segment(mart, segment).agg(
        zero_if_null(F.sum("order_count")).alias("orders")
    )


def lifetime_value(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return filter_segment(mart, segment).agg(
        to_float64(zero_if_null(F.sum("lifetime_value"))).alias("lifetime_value")
    )


def lifetime_value_by_segment(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return (
        filter_segment(mart, segment)
        .groupBy("segment")
        .agg(to_float64(F.sum("lifetime_value")).alias("lifetime_value"))
        .orderBy(F.desc_nulls_last("lifetime_value"))
    )


def activity_by_segment(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return (
        filter_segment(mart, segment)
        .groupBy("segment")
        .agg(F.sum("order_count").alias("orders"), F.sum("event_count").alias("events"))
        .orderBy(F.asc_nulls_last("segment"))
    )


def customer_detail(mart: DataFrame, segment: str | None = None) -> DataFrame:
    return (
        filter_segment(mart, segment)
        .select(
            "customer_id",
            "name",
            "segment",
            "event_count",
            "last_event_at",
            "order_count",
            to_float64("lifetime_value").alias("lifetime_value"),
            "last_order_at",
        )
        .orderBy(F.desc_nulls_last("lifetime_value"), F.asc_nulls_last("customer_id"))
    )


@dataclass(frozen=True)
class Card:
    name: str
    display: str  # scalar | bar | table
    build: Callable[[DataFrame, str | None], DataFrame]


# Card titles and display types, in dashboard order.
CARDS: tuple[Card, ...] = (
    Card("Total Customers", "scalar", total_customers),
    Card("Active Customers", "scalar", active_customers),
    Card("Total Orders", "scalar", total_orders),
    Card("Lifetime Value", "scalar", lifetime_value),
    Card("Lifetime Value by Segment", "bar", lifetime_value_by_segment),
    Card("Activity by Segment", "bar", activity_by_segment),
    Card("Customer Detail", "table", customer_detail),
)


def report_cards(mart: DataFrame, segment: str | None = None) -> dict[str, DataFrame]:
    """All cards with one shared segment filter, as lazy DataFrames."""
    return {card.name: card.build(mart, segment) for card in CARDS}


class ReportRun:
    """Run all cards against one materialized mart and keep every card's whole result.

    Each card is written, sorted as it is displayed, below the shared scratch folder and read
    back; nothing is brought to the driver, however many customers the detail card lists.
    """

    def __init__(self, mart: DataFrame):
        self.mart = mart

    def run(self, segment: str | None = None) -> dict[str, DataFrame]:
        spark, results = self.mart.sparkSession, {}
        for name, df in report_cards(self.mart, segment).items():
            path = scratch_dir(spark, "card")
            df.write.parquet(path)
            results[name] = spark.read.schema(df.schema).parquet(path)
        return results


def _measures(card: DataFrame) -> list[Column]:
    """Row count and sums over every value: numbers, text lengths, days of times."""
    numbers, texts, days = F.lit(0).cast("decimal(38,2)"), F.lit(0), F.lit(0)
    for f in card.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, NumericType):
            numbers = numbers + F.coalesce(value.cast("decimal(30,2)"), F.lit(0))
        elif isinstance(f.dataType, StringType):
            texts = texts + F.coalesce(F.length(value), F.lit(0))
        else:
            days = days + F.coalesce(F.datediff(value, F.lit("1970-01-01").cast("date")), F.lit(0))
    return [
        F.count(F.lit(1)).alias("row_count"),
        to_float64(F.coalesce(F.sum(numbers), F.lit(0))).alias("number_sum"),
        F.coalesce(F.sum(texts), F.lit(0)).cast("bigint").alias("text_length"),
        F.coalesce(F.sum(days), F.lit(0)).cast("bigint").alias("day_sum"),
    ]


def report_suite(mart: DataFrame, segment: str | None = None) -> DataFrame:
    """One row per card with its row count and sums over all its values.

    Every card is computed and written in full first (``ReportRun``), so its measures and its
    sort are part of the run.  Pass a materialized mart: the seven cards then read one row per
    customer instead of recomputing it.
    """
    results = ReportRun(mart).run(segment)
    parts = [
        results[card.name]
        .agg(*_measures(results[card.name]))
        .select(
            F.lit(position).alias("card_position"),
            F.lit(card.name).alias("card"),
            F.lit(card.display).alias("display"),
            "row_count",
            "number_sum",
            "text_length",
            "day_sum",
        )
        for position, card in enumerate(CARDS)
    ]
    return reduce(DataFrame.unionByName, parts)
