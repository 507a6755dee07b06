"""Landing writers: put a data directory's tables, whole, into the raw file shapes a
source delivers (CSV customers, JSON-document events, Parquet orders with string
timestamps, JSON Lines, API response pages).

All of them are distributed writes.  Documents and pages are built by grouping
records into blocks of a fixed number of keys, so no document grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.datetime import format_ntz
from tidepool.sources.tables import raw_table, read_table

# Records per landed document / API page; text timestamps keep micros.
DOCUMENT_BLOCK = 500
PAGE_SIZE = 1000
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def land_csv(df: DataFrame, dest: str, gzip: bool = False) -> str:
    writer = df.write.option("header", "true")
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(dest)
    return dest


def land_jsonl(df: DataFrame, dest: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.options(**JSON_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(dest)
    return dest


def land_parquet(df: DataFrame, dest: str) -> str:
    df.write.parquet(dest)
    return dest


def _by_file(df: DataFrame, name: str, key) -> DataFrame:
    """Add the output-file key ``name`` and hash-partition on it over every core: the
    grouping that follows reuses this partitioning (one shuffle), and the many small
    files are written in parallel rather than by the few tasks that adaptive
    coalescing would leave."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.withColumn(name, key).repartition(n, name)


def land_documents(
    df: DataFrame, dest: str, block_key: str, records_path: str | None = None,
    block: int = DOCUMENT_BLOCK,
) -> str:
    """One JSON document per block of ``block`` consecutive keys, one file each.

    A block holding a single record is written as an object, others as arrays of
    objects; with ``records_path`` (``a.b``) the records are nested below it.
    """
    doc = F.floor(F.col(block_key) / F.lit(block)).cast("bigint")
    grouped = _by_file(df, "doc", doc).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("recs")
    )
    # arrays span several lines (one record per line), as exported documents do
    lines = F.array_join(F.transform("recs", lambda r: F.to_json(r, JSON_OPTIONS)), ",\n  ")
    body = F.when(F.size("recs") == 1, F.to_json(F.col("recs")[0], JSON_OPTIONS)).otherwise(
        F.concat(F.lit("[\n  "), lines, F.lit("\n]"))
    )
    if records_path:
        for part in reversed(records_path.split(".")):
            body = F.concat(F.lit(f'{{"{part}": '), body, F.lit("}"))
    grouped.select("doc", body.alias("value")).write.partitionBy("doc").text(dest)
    return dest


def land_pages(df: DataFrame, dest: str, order_key: str, page_size: int = PAGE_SIZE) -> str:
    """API-style pages ``{"page": n, "data": {"items": [...]}}``, one file per page,
    records in ``order_key`` order inside a page."""
    page = F.floor(F.col(order_key) / F.lit(page_size)).cast("bigint")
    grouped = _by_file(df, "page", page).groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("items")
    )
    body = F.to_json(
        F.struct(F.col("page"), F.struct(F.col("items").alias("items")).alias("data")),
        JSON_OPTIONS,
    )
    grouped.select(F.col("page").alias("p"), body.alias("value")).write.partitionBy("p").text(dest)
    return dest


def orders_with_string_timestamps(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw orders as a source would export them: ISO-8601 UTC strings."""
    o = raw_table(spark, data_dir, "orders")
    return o.withColumn("ordered_at", F.concat(format_ntz("ordered_at", time_sep="T"), F.lit("Z")))


def customers_messy_names(spark: SparkSession, data_dir: str) -> DataFrame:
    """The customer table under header names as a spreadsheet export might have."""
    c = read_table(spark, data_dir, "customer")
    # Source header names.
    return c.select(
        F.col("c_custkey").alias("CustKey"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_nationkey").alias("nationKey"),
        F.col("c_acctbal").alias("Account-Balance"),
        F.col("c_mktsegment").alias("MKT.Segment"),
    )
