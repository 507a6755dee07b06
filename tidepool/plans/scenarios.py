"""Named queries that land inputs first: scans, ingestion, loads, normalization,
ad-hoc SQL and datetime parsing.  Every input is derived from the data directory's
tables, whole; landing and warehouse folders are fresh per call, below the shared
scratch folder.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.datetime import format_ntz, parse_datetime_best_effort
from tidepool.operators import normalize, quality
from tidepool.operators.incremental import load_incremental
from tidepool.operators.load import Warehouse
from tidepool.plans import adhoc, landing, models
from tidepool.plans.ingest import ingest
from tidepool.session import scratch_dir
from tidepool.sources.api_pages import read_resource
from tidepool.sources.documents import read_json_documents
from tidepool.sources.files import read_files
from tidepool.sources.tables import raw_table, raw_tables, read_table
from tidepool.spec import parse_source_specs
from tidepool.streaming.file_landing import ingest_new_files

# Batch boundaries of the load scenarios (orders span 1995..2001).
FIRST_BATCH_END = "1998-01-01"
SECOND_BATCH_START = "1997-01-01"
THIRD_BATCH_START = "1999-01-01"
PARAM_SEGMENT = "BUILDING"
LOG_BATCHES = 6
SMALL_FILE_ROWS = 1 << 16  # well below what a task of a compaction writes


# -- scans --------------------------------------------------------------------------


def q_scan_csv(spark: SparkSession, d: str) -> DataFrame:
    dest = landing.land_csv(raw_table(spark, d, "customers"), scratch_dir(spark, "csv"))
    return models.stg_customers(read_files(spark, f"{dest}/*.csv", "csv"))


def q_scan_csv_gz(spark, d):
    dest = landing.land_csv(raw_table(spark, d, "customers"), scratch_dir(spark, "csvgz"), gzip=True)
    return models.stg_customers(read_files(spark, f"{dest}/*.csv.gz", "csv"))


def q_scan_json(spark, d):
    dest = landing.land_documents(raw_table(spark, d, "events"), scratch_dir(spark, "docs"), "event_id")
    return models.stg_events(read_json_documents(spark, f"{dest}/**/*.txt"))


def q_scan_json_records_path(spark, d):
    dest = landing.land_documents(
        raw_table(spark, d, "events"), scratch_dir(spark, "docs"), "event_id", "data.items"
    )
    return models.stg_events(read_json_documents(spark, f"{dest}/**/*.txt", "data.items"))


def q_scan_jsonl(spark, d):
    dest = landing.land_jsonl(raw_table(spark, d, "events"), scratch_dir(spark, "jsonl"))
    return models.stg_events(read_files(spark, f"{dest}/*.json", "jsonl"))


def q_scan_parquet(spark, d):
    dest = landing.land_parquet(
        landing.orders_with_string_timestamps(spark, d), scratch_dir(spark, "parquet")
    )
    return models.stg_orders(read_files(spark, f"{dest}/*.parquet", "parquet"))


def q_scan_glob_recursive(spark, d):
    ev = raw_table(spark, d, "events").withColumns(
        {"y": F.year("occurred_at"), "m": F.month("occurred_at")}
    )
    dest = landing.land_jsonl(ev, scratch_dir(spark, "nested"), partition_by=["y", "m"])
    return models.stg_events(read_files(spark, f"{dest}/**/*.json", "jsonl"))


def _land_demo(spark, d) -> str:
    """The three demo tables in their delivered formats below one folder."""
    root = scratch_dir(spark, "inbox")
    landing.land_csv(raw_table(spark, d, "customers"), f"{root}/customers")
    landing.land_documents(raw_table(spark, d, "events"), f"{root}/events", "event_id")
    landing.land_parquet(landing.orders_with_string_timestamps(spark, d), f"{root}/orders")
    return root


def q_ingest_multi_table(spark, d):
    """Spec -> read three tables of mixed formats -> load -> staging -> mart."""
    root = _land_demo(spark, d)
    [spec] = parse_source_specs(
        {
            "version": 1,
            "sources": [
                {
                    "name": "local_demo",
                    "type": "filesystem",
                    "write_disposition": "replace",
                    "bucket_url": root,
                    "tables": [
                        {"name": "customers", "file_glob": "customers/*.csv", "format": "csv"},
                        {"name": "events", "file_glob": "events/**/*.txt", "format": "json"},
                        {"name": "orders", "file_glob": "orders/*.parquet", "format": "parquet"},
                    ],
                }
            ],
        }
    )
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"))
    ingest(spark, spec, wh)
    raw = {t: wh.read(spec.dataset_name, t) for t in ("customers", "events", "orders")}
    return models.build_mart(raw)


def q_ingest_child_tables(spark, d):
    """Records with a list (each turn's text lines) -> parent + child table on ingest."""
    conv = read_table(spark, d, "conversations").select(
        "conv_id", "turn", "role", F.split(F.col("text"), "\n").alias("lines")
    )
    root = scratch_dir(spark, "conversations")
    landing.land_jsonl(conv, f"{root}/conversations")
    [spec] = parse_source_specs(
        {
            "version": 1,
            "sources": [
                {
                    "name": "chat",
                    "type": "filesystem",
                    "write_disposition": "merge",
                    "bucket_url": root,
                    "tables": [
                        {
                            "name": "conversations",
                            "file_glob": "conversations/*.json",
                            "format": "jsonl",
                            "primary_key": ["conv_id", "turn"],
                        }
                    ],
                }
            ],
        }
    )
    wh = _wh(spark)
    ingest(spark, spec, wh)
    parent = wh.read("raw_chat", "conversations").select(
        "conv_id", "turn", F.col("_row_key").alias("_parent_key")
    )
    child = wh.read("raw_chat", "conversations__lines")
    return child.join(parent, "_parent_key").select("conv_id", "turn", "_idx", "value")


def q_ingest_api_pages(spark, d):
    root = scratch_dir(spark, "api")
    landing.land_pages(raw_table(spark, d, "orders"), f"{root}/orders", "order_id")
    pages = read_resource(spark, root, "orders", data_selector="data.items")
    return models.stg_orders(pages, extra=("_page", "_page_pos"))


def q_ingest_connector(spark, d):
    """Landed pages through a Python data source that a spec names, loaded and typed."""
    root = scratch_dir(spark, "pages")
    landing.land_pages(raw_table(spark, d, "orders"), f"{root}/orders", "order_id")
    [spec] = parse_source_specs({"version": 1, "sources": [{
        "name": "pages", "type": "connector", "connector": "tidepool.sources.landed_pages:LandedPages",
        "write_disposition": "replace", "options": {"records_path": "data.items", "number": "p=([0-9]+)/"},
        "tables": [{"name": "orders", "options": {"path": f"{root}/orders", "partition_bytes": 1 << 20},
                    "schema": "order_id bigint, customer_id bigint, amount double, ordered_at string"}]}]})
    wh = _wh(spark)
    ingest(spark, spec, wh)
    return models.stg_orders(wh.read("raw_pages", "orders"), extra=("_page", "_page_pos"))


# -- loads ----------------------------------------------------------------------------


def _orders(spark, d) -> DataFrame:
    return raw_table(spark, d, "orders")


def _first(o):
    return o.where(F.col("ordered_at") < F.lit(FIRST_BATCH_END).cast("timestamp_ntz"))


def _second(o):
    return o.where(F.col("ordered_at") >= F.lit(SECOND_BATCH_START).cast("timestamp_ntz"))


def _third(o):
    return o.where(F.col("ordered_at") >= F.lit(THIRD_BATCH_START).cast("timestamp_ntz"))


def _later(o):
    return o.where(F.col("ordered_at") >= F.lit(FIRST_BATCH_END).cast("timestamp_ntz"))


def _wh(spark) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, "warehouse"))


def q_load_append(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    wh.load(_first(o), "raw", "orders", "append")
    wh.load(_second(o), "raw", "orders", "append")
    return wh.read("raw", "orders")


class _LostDriver(Warehouse):
    """Ends after the data job of a load, before its audit row."""

    def _record(self, *args, **fields):
        raise InterruptedError("driver lost")


def q_load_replay(spark, d):
    """An append and a merge that fail before they are recorded, each run again."""
    o, wh = _orders(spark, d), _wh(spark)
    lost = _LostDriver(spark, wh.root)
    for table, disposition, key in (("plain", "append", None), ("keyed", "merge", ["order_id"])):
        wh.load(_first(o), "raw", table, "append", primary_key=key)
        later = _later(o).withColumn("amount", F.col("amount") + 1)
        with contextlib.suppress(InterruptedError):
            lost.load(later, "raw", table, disposition, primary_key=key)
        wh.load(later, "raw", table, disposition, primary_key=key)
    tables = [wh.read("raw", t).withColumn("loaded_into", F.lit(t)) for t in ("plain", "keyed")]
    return tables[0].unionByName(tables[1])


def q_load_replace(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    wh.load(_first(o), "raw", "orders", "replace")
    wh.load(_second(o), "raw", "orders", "replace")
    return wh.read("raw", "orders")


def _merge_batches(o):
    first = _first(o).withColumn("seq", F.lit(1))
    second = _second(o).withColumns({"amount": F.col("amount") + 1, "seq": F.lit(2)})
    third = _third(o).withColumns({"amount": F.col("amount") + 2, "seq": F.lit(3)})
    return first, second.unionByName(third)


def q_load_merge(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    first, later = _merge_batches(o)
    wh.load(first, "raw", "orders", "merge", primary_key=["order_id"], order_by=["seq"])
    wh.load(later, "raw", "orders", "merge", order_by=["seq"])
    return wh.read("raw", "orders")


def q_load_insert_ignore(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    wh.load(_first(o), "raw", "orders", "insert_ignore", primary_key=["order_id"])
    wh.load(_second(o).withColumn("amount", F.col("amount") + 1), "raw", "orders", "insert_ignore")
    return wh.read("raw", "orders")


def q_load_schema_evolution(spark, d):
    wh = _wh(spark)
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_orderpriority").alias("priority"),
    )
    wh.load(_first(o).drop("priority"), "raw", "orders", "append")
    wh.load(_second(o), "raw", "orders", "append")
    return wh.read("raw", "orders")


def q_load_type_conflict(spark, d):
    wh = _wh(spark)
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("ordered_at"),
    )
    # Fixed value: the text a source sends instead of a number.
    as_text = F.when(F.col("priority") == "5-LOW", F.lit("unknown")).otherwise(
        F.col("amount").cast("string")
    )
    wh.load(_first(o).select("order_id", "amount"), "raw", "orders", "append")
    wh.load(_second(o).select("order_id", as_text.alias("amount")), "raw", "orders", "append")
    return wh.read("raw", "orders")


def q_load_incremental_cursor(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    load_incremental(_first(o), wh, "raw", "orders", "ordered_at", ["order_id"])
    load_incremental(o, wh, "raw", "orders", "ordered_at", ["order_id"])
    return wh.read("raw", "orders")


ORDERS_SCHEMA = "order_id bigint, customer_id bigint, amount double, ordered_at timestamp_ntz"


def q_load_incremental_files(spark, d):
    """Files arrive in two batches; three runs load batch 1, batch 2, then nothing."""
    o, wh = _orders(spark, d), _wh(spark)
    inbox, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-checkpoint")

    def run():
        return ingest_new_files(
            spark, f"{inbox}/**/*.parquet", "parquet", ORDERS_SCHEMA, wh, "raw", "orders", checkpoint
        )

    _first(o).write.parquet(f"{inbox}/batch=1")
    run()
    _later(o).write.parquet(f"{inbox}/batch=2")
    run()
    if run().rows_loaded:
        raise RuntimeError("a rerun without new files loaded rows")
    return wh.read("raw", "orders")


def q_load_audit(spark, d):
    o, wh = _orders(spark, d), _wh(spark)
    wh.load(_first(o), "raw", "orders", "append", primary_key=["order_id"])
    wh.load(_second(o), "raw", "orders", "append")
    wh.load(_second(o), "raw", "orders", "replace")
    wh.load(_first(o), "raw", "orders", "merge")
    return wh.audit().select("load_seq", "table_name", "disposition", "rows_in", "rows_loaded")


def q_mart_materialized(spark, d):
    wh = _wh(spark)
    wh.load(models.build_mart(raw_tables(spark, d)), "analytics", "customer_activity", "replace")
    return wh.read("analytics", "customer_activity")


def q_load_log_replay(spark, d):
    """Appends, a merge, a compaction and a replace; then the table as it was after each of them.

    The merge cuts its files at a 64th of the table's rows, so that the compaction has small files to put together.
    """
    o = _orders(spark, d)
    log = {"buckets": 2, "snapshot_every": 3, "fold": 4}
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), **log)
    for k in range(LOG_BATCHES):
        wh.load(o.where(F.col("order_id") % LOG_BATCHES == k), "raw", "orders", "append", primary_key=["order_id"])
    rows = sum(f.rows for f in wh.state("raw", "orders").files.values())
    small = Warehouse(spark, wh.root, file_rows=min(max(rows // 64, 1), SMALL_FILE_ROWS), **log)
    small.load(o.where("order_id % 2 = 0").withColumn("amount", F.col("amount") + 1), "raw", "orders", "merge")
    merged = wh.state("raw", "orders")
    wh.compact("raw", "orders")  # of one file a bucket there is nothing to put together, and no load of its own
    compacted = wh.state("raw", "orders")
    if compacted.load_seq > merged.load_seq and len(compacted.files) >= len(merged.files):
        raise RuntimeError("the compaction left as many files as it found")
    wh.load(o.where("order_id % 3 = 0"), "raw", "orders", "replace")
    after = [*range(1, merged.load_seq + 1), compacted.load_seq, wh.state("raw", "orders").load_seq]
    states = None
    for n, seq in enumerate(after, 1):
        one = wh.read("raw", "orders", load_seq=seq).withColumn("load_seq", F.lit(n).cast("long"))
        states = one if states is None else states.unionByName(one)
    cents = F.sum(F.round(F.col("amount") * 100).cast("long"))
    return states.groupBy("load_seq").agg(
        F.count("*").alias("n"), F.sum("order_id").alias("order_ids"), cents.alias("cents")
    )


def q_load_compact(spark, d):
    """Many small loads put together: the rows after it, and those of the state before it."""
    o = _orders(spark, d)
    wh = _wh(spark)
    for k in range(LOG_BATCHES):
        wh.load(o.where(F.col("order_id") % LOG_BATCHES == k), "raw", "orders", "append")
    before = wh.state("raw", "orders")
    wh.compact("raw", "orders")
    if len(wh.state("raw", "orders").folders()) >= len(before.folders()):
        raise RuntimeError("the compaction left as many folders as it found")
    states = (("before", wh.read("raw", "orders", before.load_seq)), ("after", wh.read("raw", "orders")))
    rows = [df.withColumn("state", F.lit(name)) for name, df in states]
    return rows[0].unionByName(rows[1])


def q_load_merge_few_keys(spark, d):
    """A merge of a few keys into a table of many files rewrites the files that can hold them."""
    o = _orders(spark, d)
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), buckets=4, file_rows=200)
    wh.load(o, "raw", "orders", "merge", primary_key=["order_id"])
    files = len(wh.state("raw", "orders").files)
    few = o.groupBy((F.col("order_id") % 5).alias("k")).agg(F.max("order_id").alias("order_id"))
    batch = o.join(few.select("order_id"), "order_id").withColumn("amount", F.lit(0.0))
    load = wh.load(batch.select(o.columns), "raw", "orders", "merge")
    told = wh.audit().where(F.col("load_id") == load.load_id).first()
    if told.files_read > load.rows_loaded or (files > 20 and 2 * told.files_read > files):
        raise RuntimeError(f"a merge of {load.rows_loaded} keys read {told.files_read} of {files} files")
    return wh.read("raw", "orders")


def q_dq_unique_buckets(spark, d):
    """The key of a bucketed table tested after every load, each time where files have changed.

    The mart is loaded whole, some of its rows come twice by an append, and a merge of all of them
    puts one row in the place of two.
    """
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"), buckets=8)
    rows = models.build_mart(raw_tables(spark, d))
    again = rows.where("customer_id % 7 = 0")
    out = None
    for run, (batch, disposition) in enumerate(((rows, "replace"), (again, "append"), (again, "delete_insert"))):
        wh.load(batch, "analytics", "customer_activity", disposition, primary_key=["customer_id"])
        result = quality.unique_in_buckets(wh, "analytics", "customer_activity").drop("buckets_read")
        result = result.withColumn("run", F.lit(run + 1).cast("long"))
        out = result if out is None else out.unionByName(result)
    if quality.unique_in_buckets(wh, "analytics", "customer_activity").first().buckets_read:
        raise RuntimeError("a run without a load in between read buckets")
    return out


# -- normalization ----------------------------------------------------------------


def q_normalize_names(spark, d):
    return normalize.normalize_names(landing.customers_messy_names(spark, d))


def q_normalize_flatten(spark, d):
    ev = read_table(spark, d, "events")
    return normalize.flatten(normalize.parse_json_column(ev, "props"))


def q_normalize_child_table(spark, d):
    conv = read_table(spark, d, "conversations").withColumn(
        "lines", F.split(F.col("text"), "\n")
    )
    return normalize.child_table(conv, ["conv_id", "turn"], "lines")


# -- ad-hoc SQL and functions ----------------------------------------------------------


def q_adhoc_sum(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    dest = landing.land_csv(o, scratch_dir(spark, "adhoc"))
    return adhoc.query_file(
        spark,
        f"{dest}/*.csv",
        "SELECT count(*) AS n, sum(o_custkey) AS custkey_sum, "
        "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM source",
    )


def q_adhoc_preview(spark, d):
    dest = landing.land_parquet(read_table(spark, d, "customer"), scratch_dir(spark, "adhoc"))
    return adhoc.query_file(spark, f"{dest}/*", "SELECT * FROM source ORDER BY c_custkey LIMIT 20")


def q_adhoc_sum_by_customer(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_totalprice")
    dest = landing.land_jsonl(o, scratch_dir(spark, "adhoc"))
    return adhoc.query_file(
        spark,
        f"{dest}/*.json",
        "SELECT o_custkey AS customer_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount "
        "FROM source GROUP BY o_custkey",
    )


def q_adhoc_param_sql(spark, d):
    mart = models.build_mart(raw_tables(spark, d))
    return adhoc.native_query(
        spark,
        "SELECT segment, count(*) AS customers, CAST(sum(lifetime_value) AS DOUBLE) AS lifetime_value "
        "FROM {mart} WHERE (:segment IS NULL OR segment = :segment) GROUP BY segment",
        args={"segment": PARAM_SEGMENT},
        mart=mart,
    )


def datetime_renderings(o: DataFrame) -> DataFrame:
    """Order dates as differently formatted strings, one format per priority."""
    ts = F.col("o_orderdate")
    epoch = (
        F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    )
    # Priority -> rendering.
    rendered = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(format_ntz(ts, time_sep="T"), F.lit("Z")))
        .when(
            F.col("o_orderpriority") == "2-HIGH",
            format_ntz(ts, date_sep="/", day_first=True, seconds=False),
        )
        .when(F.col("o_orderpriority") == "3-MEDIUM", epoch.cast("string"))
        .when(
            F.col("o_orderpriority") == "5-LOW",
            F.concat(format_ntz(ts + F.expr("INTERVAL 2 HOURS"), time_sep="T"), F.lit("+02:00")),
        )
        .otherwise(format_ntz(ts))
    )
    return o.select("o_orderkey", "o_orderpriority", rendered.alias("raw_value"))


def q_fn_parse_datetime(spark, d):
    rendered = datetime_renderings(read_table(spark, d, "orders"))
    return rendered.select(
        "o_orderkey", "o_orderpriority", parse_datetime_best_effort("raw_value").alias("parsed_at")
    )


# -- cases beyond the friendly path ----------------------------------------------------------


def q_fn_parse_datetime_compact(spark, d):
    """Compact dates and date-times (by order number), and epoch seconds."""
    o = read_table(spark, d, "orders")
    date = F.date_format("o_orderdate", "yyyyMMdd")
    raw = (
        F.when(F.col("o_orderkey") % 3 == 0, date)
        .when(F.col("o_orderkey") % 3 == 1, F.concat(date, F.lit("101530")))
        .otherwise((F.lit(1_600_000_000) + F.col("o_orderkey")).cast("string"))
    )
    return o.select("o_orderkey", parse_datetime_best_effort(raw).alias("parsed_at"))


def q_adhoc_json_long_line(spark, d):
    """A JSON Lines file named .json whose first line is far longer than its others."""
    long = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("doc_id"), F.repeat(F.lit("long "), 20_000).alias("text")
    )
    rows = long.unionByName(read_table(spark, d, "documents").select("doc_id", "text"))
    dest = landing.land_jsonl(rows, scratch_dir(spark, "adhoc"))
    return adhoc.query_file(
        spark, f"{dest}/*.json", "SELECT count(*) AS n, sum(length(text)) AS chars FROM source"
    )


def q_load_type_narrowing(spark, d):
    """A bigint column that receives fractions keeps them beside, digits and all."""
    o = read_table(spark, d, "orders")
    wh = _wh(spark)
    whole = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("v"))
    wh.load(whole, "raw", "narrow", "append")
    other = o.where("o_orderkey % 2 = 1").select(
        "o_orderkey", (F.col("o_custkey") + F.when(F.col("o_orderkey") % 3 == 0, 0.75).otherwise(0.0)).alias("v")
    )
    wh.load(other, "raw", "narrow", "append")
    return wh.read("raw", "narrow").select("o_orderkey", "v", "v__v_double")


def q_load_cursor_ties_no_key(spark, d):
    """Reruns of an unkeyed cursor load neither repeat nor lose the rows at the mark."""
    ev = read_table(spark, d, "events").select("event_id", F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day"))
    wh = _wh(spark)
    early = ev.where("event_id % 3 <> 0")
    for batch in (early, early, ev):  # of the whole table only the days from the mark on
        load_incremental(batch, wh, "raw", "ties", "day")
    return wh.read("raw", "ties").select("event_id", "day")


def q_scan_csv_quoted(spark, d):
    """Quotes, commas and line breaks inside quoted fields."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    hard = F.concat(F.lit('say "hi", '), F.col("o_orderpriority"), F.lit("\nsecond line"))
    dest = scratch_dir(spark, "quoted")
    rows = o.select("o_orderkey", hard.alias("note"))
    rows.write.option("header", "true").option("quote", '"').option("escape", '"').csv(dest)
    return read_files(
        spark, f"{dest}/*.csv", "csv", schema="o_orderkey bigint, note string", options={"multiLine": "true"}
    )


def q_scan_glob_residual(spark, d):
    """Files selected below a pattern's middle folder; the others take no part in inference."""
    ev = read_table(spark, d, "events").select("event_id", "user_id")
    root = f"{scratch_dir(spark, 'residual')}/in box"
    landing.land_jsonl(ev.where("event_id % 2 = 0"), f"{root}/x/a")
    landing.land_jsonl(ev.where("event_id % 2 = 1").withColumn("foreign", F.lit(1)), f"{root}/x/b")
    return read_files(spark, f"{root}/**/a/*.json", "jsonl")


def _child_spec(root: str):
    [spec] = parse_source_specs(
        {
            "version": 1,
            "sources": [
                {
                    "name": "lists",
                    "type": "filesystem",
                    "write_disposition": "merge",
                    "bucket_url": root,
                    "tables": [
                        {"name": "parents", "file_glob": "*.json", "format": "jsonl", "primary_key": "OrderId",
                         "order_by": "Version", "schema": "OrderId bigint, Version int, Tags array<string>"}
                    ],
                }
            ],
        }
    )
    return spec


def _bytes(key: str):
    """A key's digest: half as long as its text to shuffle."""
    return F.unhex(F.col(key))


def _ingest_lists(spark, batches):
    wh = _wh(spark)
    for batch in batches:
        dest = landing.land_jsonl(batch, scratch_dir(spark, "lists"))
        ingest(spark, _child_spec(dest), wh)
    parents = wh.read("raw_lists", "parents").select("order_id", _bytes("_row_key").alias("parent"))
    tags = wh.read("raw_lists", "parents__tags").select(_bytes("_parent_key").alias("parent"), "_idx", "value")
    return tags.join(parents, "parent").select("order_id", "_idx", "value")


def _tagged(spark, d, version: int, tags):
    o = read_table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("OrderId"), F.lit(version).alias("Version"), tags.alias("Tags"))


def q_ingest_child_shrink(spark, d):
    """Lists that shrink, some to nothing, leave no stale elements."""
    pair = F.array(F.col("o_orderpriority"), F.col("o_orderstatus"))
    less = F.slice(pair, 1, (F.col("o_orderkey") % 2).cast("int"))
    return _ingest_lists(spark, [_tagged(spark, d, 1, pair), _tagged(spark, d, 2, less)])


def q_ingest_child_duplicate_parents(spark, d):
    """Of two versions of a parent in one batch only the later one's list is loaded."""
    old = _tagged(spark, d, 1, F.array(F.lit("old1"), F.lit("old2")))
    new = _tagged(spark, d, 2, F.array(F.col("o_orderstatus")))
    return _ingest_lists(spark, [old.unionByName(new)])


def q_ingest_grandchildren_shrink(spark, d):
    """Lists of lists whose outer or inner lists shrink leave no elements at any depth."""
    key = F.col("o_orderkey")
    pair = F.array(F.col("o_orderstatus"), F.col("o_orderpriority"))
    deep = F.array(*(F.struct(F.lit(g).alias("Name"), F.array(F.struct(pair.alias("Marks"))).alias("Parts")) for g in "ab"))
    # by order: both groups, one, none; in what is left one mark instead of two
    fewer = F.transform(
        F.slice(deep, 1, (key % 3).cast("int")),
        lambda g: F.struct(
            g["Name"].alias("Name"),
            F.transform(g["Parts"], lambda p: F.struct(F.slice(p["Marks"], 1, 1).alias("Marks"))).alias("Parts"),
        ),
    )
    o = read_table(spark, d, "orders")
    batches = [
        o.select(key.alias("OrderId"), deep.alias("Groups")),
        o.where("o_orderkey % 2 = 0").select(key.alias("OrderId"), fewer.alias("Groups")),
    ]
    wh = _wh(spark)
    for batch in batches:
        dest = landing.land_jsonl(batch, scratch_dir(spark, "nested-lists"))
        [spec] = parse_source_specs({"version": 1, "sources": [{
            "name": "deep", "type": "filesystem", "write_disposition": "merge", "bucket_url": dest,
            "tables": [{"name": "orders", "file_glob": "*.json", "format": "jsonl", "primary_key": "OrderId",
                        "schema": "OrderId bigint, Groups array<struct<Name: string, "
                                  "Parts: array<struct<Marks: array<string>>>>>"}]}]})  # fmt: skip
        ingest(spark, spec, wh)
    tables = ("orders", "orders__groups", "orders__groups__parts", "orders__groups__parts__marks")
    orders, groups, parts, marks = (wh.read("raw_deep", t) for t in tables)
    orders = orders.select("order_id", _bytes("_row_key").alias("root"))
    groups = groups.select("name", _bytes("_row_key").alias("group"))
    parts = parts.select(_bytes("_parent_key").alias("group"), _bytes("_row_key").alias("part"))
    marks = marks.select(
        _bytes("_root_key").alias("root"), _bytes("_parent_key").alias("part"), F.col("_idx").alias("position"), "value"
    )
    # left joins: an element whose parents are gone would show as NULL
    named = parts.join(groups, "group", "left").select("part", "name")
    return (
        marks.join(named, "part", "left").join(orders, "root", "left")
        .select("order_id", "name", "position", "value")
    )


SCENARIOS = {
    "scan_csv": q_scan_csv,
    "scan_csv_gz": q_scan_csv_gz,
    "scan_json": q_scan_json,
    "scan_json_records_path": q_scan_json_records_path,
    "scan_jsonl": q_scan_jsonl,
    "scan_parquet": q_scan_parquet,
    "scan_glob_recursive": q_scan_glob_recursive,
    "ingest_multi_table": q_ingest_multi_table,
    "ingest_api_pages": q_ingest_api_pages,
    "ingest_child_tables": q_ingest_child_tables,
    "ingest_connector": q_ingest_connector,
    "load_append": q_load_append,
    "load_replace": q_load_replace,
    "load_replay": q_load_replay,
    "load_merge": q_load_merge,
    "load_insert_ignore": q_load_insert_ignore,
    "load_schema_evolution": q_load_schema_evolution,
    "load_type_conflict": q_load_type_conflict,
    "load_incremental_cursor": q_load_incremental_cursor,
    "load_incremental_files": q_load_incremental_files,
    "load_audit": q_load_audit,
    "load_log_replay": q_load_log_replay,
    "load_compact": q_load_compact,
    "load_merge_few_keys": q_load_merge_few_keys,
    "dq_unique_buckets": q_dq_unique_buckets,
    "mart_materialized": q_mart_materialized,
    "normalize_names": q_normalize_names,
    "normalize_flatten": q_normalize_flatten,
    "normalize_child_table": q_normalize_child_table,
    "adhoc_sum": q_adhoc_sum,
    "adhoc_preview": q_adhoc_preview,
    "adhoc_sum_by_customer": q_adhoc_sum_by_customer,
    "adhoc_param_sql": q_adhoc_param_sql,
    "fn_parse_datetime": q_fn_parse_datetime,
    "fn_parse_datetime_compact": q_fn_parse_datetime_compact,
    "adhoc_json_long_line": q_adhoc_json_long_line,
    "load_type_narrowing": q_load_type_narrowing,
    "load_cursor_ties_no_key": q_load_cursor_ties_no_key,
    "scan_csv_quoted": q_scan_csv_quoted,
    "scan_glob_residual": q_scan_glob_residual,
    "ingest_child_shrink": q_ingest_child_shrink,
    "ingest_grandchildren_shrink": q_ingest_grandchildren_shrink,
    "ingest_child_duplicate_parents": q_ingest_child_duplicate_parents,
}
