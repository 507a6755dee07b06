"""Parquet tables of a data directory, and their mapping onto raw source shapes.

The data directory holds one Parquet file per table (``<dir>/<name>.parquet``).  The
raw-source adapters project the columns the staging models need under the names the
staging models use, so the scan reads only those columns (``ReadSchema`` is pruned).

Mapping (fixed):
    customers  <- customer (c_custkey -> customer_id, c_name -> name, c_mktsegment -> segment)
    events     <- events   (event_id, user_id -> customer_id, event_type -> event_name, ts -> occurred_at)
    orders     <- orders   (o_orderkey -> order_id, o_custkey -> customer_id,
                            o_totalprice -> amount, o_orderdate -> ordered_at)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

RAW_MAPPINGS: dict[str, tuple[str, dict[str, str]]] = {
    "customers": (
        "customer",
        {"customer_id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"},
    ),
    "events": (
        "events",
        {
            "event_id": "event_id",
            "customer_id": "user_id",
            "event_name": "event_type",
            "occurred_at": "ts",
        },
    ),
    "orders": (
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "amount": "o_totalprice",
            "ordered_at": "o_orderdate",
        },
    ),
}


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(data_dir, name))


def raw_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One raw source table (``customers``, ``events`` or ``orders``)."""
    source, mapping = RAW_MAPPINGS[name]
    df = read_table(spark, data_dir, source)
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])


def raw_tables(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, data_dir, name) for name in RAW_MAPPINGS}
