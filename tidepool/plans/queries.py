"""Named queries over a data directory: one per operator of the inventory.

Each entry takes ``(spark, data_dir)`` and returns a DataFrame.  Entries that
exercise loads or file formats first write their inputs (derived from the data
directory's tables, whole) below the shared scratch folder and then return a lazy
read of the result.  Column names match the SQL in ``tidepool.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.operators import quality
from tidepool.plans import models, reports
from tidepool.session import scratch_dir
from tidepool.sources.tables import raw_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

# The segment used by the filtered cards, and one that does not exist.
FILTER_SEGMENT = "FURNITURE"
UNKNOWN_SEGMENT = "NO_SUCH_SEGMENT"


def mart(spark: SparkSession, data_dir: str) -> DataFrame:
    return models.build_mart(raw_tables(spark, data_dir))


def materialized_mart(spark: SparkSession, data_dir: str) -> DataFrame:
    """The mart written once as a Parquet table in the shared folder and read back:
    lineage is cut, and each card reads only its columns (segment filter pushed)."""
    path = scratch_dir(spark, "mart")
    mart(spark, data_dir).write.parquet(path)
    return spark.read.parquet(path)


# -- staging, aggregation, join, mart ----------------------------------------------


def q_stg_customers(spark, d):
    return models.stg_customers(raw_tables(spark, d)["customers"])


def q_stg_events(spark, d):
    return models.stg_events(raw_tables(spark, d)["events"])


def q_stg_orders(spark, d):
    return models.stg_orders(raw_tables(spark, d)["orders"])


def q_agg_events_by_customer(spark, d):
    return models.events_by_customer(q_stg_events(spark, d))


def q_agg_orders_by_customer(spark, d):
    return models.orders_by_customer(q_stg_orders(spark, d))


def q_join_left_using(spark, d):
    customers = q_stg_customers(spark, d)
    return customers.join(q_agg_events_by_customer(spark, d), "customer_id", "left")


def q_customer_activity(spark, d):
    return mart(spark, d)


# -- report cards -------------------------------------------------------------------


def _card(builder, segment=None) -> QueryFn:
    def run(spark, d):
        return builder(mart(spark, d), segment)

    return run


def q_report_suite(spark, d):
    # the mart is computed once and written as a table (as a dashboard sees it);
    # the seven cards then read one row per customer
    return reports.report_suite(materialized_mart(spark, d))


def q_report_suite_filtered(spark, d):
    return reports.report_suite(materialized_mart(spark, d), FILTER_SEGMENT)


# -- data tests ---------------------------------------------------------------------


def q_dq_not_null(spark, d):
    raw = raw_tables(spark, d)
    parts = [quality.SOURCE_TESTS[n].results(raw[n]) for n in ("customers", "events", "orders")]
    parts.append(quality.not_null(mart(spark, d), "customer_activity", ("customer_id", "lifetime_value")))
    return quality.union_results(parts)


def q_dq_unique(spark, d):
    raw = raw_tables(spark, d)
    return quality.union_results(
        [
            quality.unique(mart(spark, d), "customer_activity", "customer_id"),
            # deliberately failing: a customer has many events
            quality.unique(models.stg_events(raw["events"]), "events", "customer_id"),
        ]
    )


def q_dq_build(spark, d):
    """The project built into a warehouse; the results as recomputed on the written mart."""
    from tidepool.operators.load import Warehouse
    from tidepool.plans.build import build_project

    warehouse = Warehouse(spark, scratch_dir(spark, "build"))
    raw = raw_tables(spark, d)
    report = build_project(raw, warehouse=warehouse)
    return quality.suite_results(raw, report.models["customer_activity"])


def q_dq_suite(spark, d):
    raw = raw_tables(spark, d)
    return quality.suite_results(raw, models.build_mart(raw))


# queries that only read: each call is a lazy DataFrame
CORE_QUERIES: dict[str, QueryFn] = {
    "stg_customers": q_stg_customers,
    "stg_events": q_stg_events,
    "stg_orders": q_stg_orders,
    "agg_events_by_customer": q_agg_events_by_customer,
    "agg_orders_by_customer": q_agg_orders_by_customer,
    "join_left_using": q_join_left_using,
    "customer_activity": q_customer_activity,
    "card_total_customers": _card(reports.total_customers),
    "card_active_customers": _card(reports.active_customers),
    "card_total_orders": _card(reports.total_orders),
    "card_lifetime_value": _card(reports.lifetime_value),
    "card_ltv_by_segment": _card(reports.lifetime_value_by_segment),
    "card_activity_by_segment": _card(reports.activity_by_segment),
    "card_customer_detail": _card(reports.customer_detail),
    "card_total_customers_filtered": _card(reports.total_customers, FILTER_SEGMENT),
    "card_active_customers_filtered": _card(reports.active_customers, FILTER_SEGMENT),
    "card_total_orders_filtered": _card(reports.total_orders, FILTER_SEGMENT),
    "card_lifetime_value_filtered": _card(reports.lifetime_value, FILTER_SEGMENT),
    "card_ltv_by_segment_filtered": _card(reports.lifetime_value_by_segment, FILTER_SEGMENT),
    "card_activity_by_segment_filtered": _card(reports.activity_by_segment, FILTER_SEGMENT),
    "card_customer_detail_filtered": _card(reports.customer_detail, FILTER_SEGMENT),
    "card_total_orders_unknown_segment": _card(reports.total_orders, UNKNOWN_SEGMENT),
    "card_lifetime_value_unknown_segment": _card(reports.lifetime_value, UNKNOWN_SEGMENT),
    "report_suite": q_report_suite,
    "report_suite_filtered": q_report_suite_filtered,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_suite": q_dq_suite,
    "dq_build": q_dq_build,
}


# queries that land inputs or load tables first (eager writes, lazy result)
from tidepool.plans.scenarios import SCENARIOS  # noqa: E402

QUERIES: dict[str, QueryFn] = {**CORE_QUERIES, **SCENARIOS}
