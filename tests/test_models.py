"""Golden test of the mart and report cards on a small invented harbour business, in the shapes
a source delivers: CSV customers, a JSON document of events, Parquet orders with string times."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from tidepool.operators.load import Warehouse
from tidepool.plans import models, reports
from tidepool.plans.ingest import ingest
from tidepool.spec import parse_source_specs

CUSTOMERS_CSV = (
    "customer_id,name,segment,created_at\n"
    "11,Nordkai Stauerei,freight,2025-02-11T06:15:00Z\n"
    "12,Pension Möwe,leisure,2025-02-14T19:00:00Z\n"
    "13,Werft Ostrand,freight,2025-03-01T08:45:00Z\n"
    "14,Bootsverleih Lind,leisure,2025-03-09T12:00:00Z\n"
)
EVENTS = [
    {"event_id": 1, "customer_id": 11, "event_name": "berth_booked", "occurred_at": "2025-04-02T05:30:00Z"},
    {"event_id": 2, "customer_id": 12, "event_name": "tour_viewed", "occurred_at": "2025-04-03T20:10:00Z"},
    {"event_id": 3, "customer_id": 12, "event_name": "tour_booked", "occurred_at": "2025-04-03T20:25:00Z"},
    {"event_id": 4, "customer_id": 12, "event_name": "tour_rated", "occurred_at": "2025-04-06T09:00:00Z"},
    {"event_id": 5, "customer_id": 13, "event_name": "berth_viewed", "occurred_at": "2025-04-07T10:00:00Z"},
]
ORDERS = [
    (501, 11, 980.10, "2025-04-02T05:31:00Z"),
    (502, 12, 55.25, "2025-04-03T20:26:00Z"),
    (503, 12, 14.75, "2025-04-05T11:00:00Z"),
    (504, 11, 120.40, "2025-04-09T07:00:00Z"),
    (505, 11, 0.50, "2025-04-10T07:00:00Z"),
]


@pytest.fixture(scope="module")
def demo_mart(spark, tmp_path_factory):
    inbox = tmp_path_factory.mktemp("inbox")
    (inbox / "customers.csv").write_text(CUSTOMERS_CSV, encoding="utf-8")
    (inbox / "events.json").write_text(json.dumps(EVENTS), encoding="utf-8")
    spark.createDataFrame(ORDERS, "order_id long, customer_id long, amount double, ordered_at string") \
        .coalesce(1).write.parquet(str(inbox / "orders.parquet"))
    [spec] = parse_source_specs(
        {
            "version": 1,
            "sources": [
                {
                    "name": "local_demo",
                    "type": "filesystem",
                    "write_disposition": "replace",
                    "bucket_url": str(inbox),
                    "tables": [
                        {"name": "customers", "file_glob": "customers.csv", "format": "csv"},
                        {"name": "events", "file_glob": "events.json", "format": "json"},
                        {"name": "orders", "file_glob": "orders.parquet", "format": "parquet"},
                    ],
                }
            ],
        }
    )
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    report = ingest(spark, spec, wh)
    assert [(r.table, r.rows_loaded) for r in report.loads] == [("customers", 4), ("events", 5), ("orders", 5)]
    raw = {t: wh.read("raw_local_demo", t) for t in ("customers", "events", "orders")}
    return models.build_mart(raw).cache()


def test_golden_mart(demo_mart):
    rows = {r.customer_id: r for r in demo_mart.collect()}
    assert demo_mart.columns == list(models.MART_COLUMNS)
    assert dict(demo_mart.dtypes)["lifetime_value"] == "decimal(28,2)"
    dock, inn, yard, boats = rows[11], rows[12], rows[13], rows[14]
    assert (dock.segment, dock.event_count, dock.order_count, dock.lifetime_value) == ("freight", 1, 3, Decimal("1101.00"))
    assert dock.last_event_at == dt.datetime(2025, 4, 2, 5, 30)
    assert dock.last_order_at == dt.datetime(2025, 4, 10, 7)
    assert (inn.event_count, inn.order_count, inn.lifetime_value) == (3, 2, Decimal("70.00"))
    assert inn.last_event_at == dt.datetime(2025, 4, 6, 9) and inn.last_order_at == dt.datetime(2025, 4, 5, 11)
    assert (yard.event_count, yard.order_count, yard.lifetime_value) == (1, 0, Decimal("0.00"))
    assert yard.last_order_at is None
    assert (boats.event_count, boats.last_event_at, boats.last_order_at) == (0, None, None)


def test_golden_cards(demo_mart):
    cards = reports.report_cards(demo_mart)
    assert cards["Total Customers"].first().customers == 4
    assert cards["Active Customers"].first().active_customers == 3
    assert cards["Total Orders"].first().orders == 5
    assert cards["Lifetime Value"].first().lifetime_value == pytest.approx(1171.0)
    by_value = [tuple(r) for r in cards["Lifetime Value by Segment"].collect()]
    assert by_value == [("freight", 1101.0), ("leisure", 70.0)]
    by_name = [tuple(r) for r in cards["Activity by Segment"].collect()]
    assert by_name == [("freight", 3, 2), ("leisure", 2, 3)]
    assert [r.customer_id for r in cards["Customer Detail"].collect()] == [11, 12, 13, 14]


def test_cards_filtered_and_unknown_segment(demo_mart):
    cards = reports.report_cards(demo_mart, "leisure")
    assert cards["Total Customers"].first().customers == 2
    assert cards["Lifetime Value"].first().lifetime_value == pytest.approx(70.0)
    unknown = reports.report_cards(demo_mart, "no_such_segment")
    assert unknown["Total Orders"].first().orders == 0
    assert unknown["Lifetime Value"].first().lifetime_value == 0.0
    assert unknown["Active Customers"].first().active_customers == 0
    assert unknown["Customer Detail"].count() == 0


def test_report_run_keeps_every_row(spark, demo_mart):
    results = reports.ReportRun(demo_mart).run("freight")
    assert len(results) == 7 and results["Customer Detail"].count() == 2
    many = demo_mart.where("customer_id = 11").crossJoin(spark.range(150).withColumnRenamed("id", "n"))
    assert reports.ReportRun(many.drop("n")).run()["Customer Detail"].count() == 150
    suite = {r.card: r for r in reports.report_suite(demo_mart).collect()}
    assert suite["Customer Detail"].row_count == 4 and suite["Activity by Segment"].row_count == 2
    assert suite["Lifetime Value"].number_sum == pytest.approx(1171.0)
    assert suite["Total Orders"].number_sum == 5


def test_customer_without_events_or_orders_and_null_keys(spark):
    customers = spark.createDataFrame([(1, "a", "s"), (None, "b", "s")], "customer_id long, name string, segment string")
    events = spark.createDataFrame(
        [(1, None, "x", dt.datetime(2026, 1, 1)), (2, None, "x", dt.datetime(2026, 1, 2))],
        "event_id long, customer_id long, event_name string, occurred_at timestamp_ntz",
    )
    orders = spark.createDataFrame([], "order_id long, customer_id long, amount double, ordered_at string")
    mart = models.build_mart({"customers": customers, "events": events, "orders": orders})
    rows = sorted(mart.collect(), key=lambda r: (r.customer_id is None, r.customer_id))
    assert [(r.customer_id, r.event_count, r.order_count, str(r.lifetime_value)) for r in rows] == [
        (1, 0, 0, "0.00"),
        (None, 0, 0, "0.00"),
    ]


def test_views_for_sql_users(spark, demo_mart):
    from tidepool.plans.models import register_views
    from tidepool.sources.tables import raw_tables

    register_views(spark, raw_tables(spark, "/root/testdata/sf0.001"))
    n = spark.sql("SELECT count(*) AS n FROM customer_activity").first().n
    assert n == spark.sql("SELECT count(*) AS n FROM stg_customers").first().n > 0
