"""Reference SQL (DuckDB dialect, ANSI where possible) for the named queries.

The views ``customer``, ``orders``, ``events`` ... are the data directory's tables.
Column names and types are aligned with the Spark results.
"""

from __future__ import annotations

from tidepool.plans.queries import FILTER_SEGMENT, UNKNOWN_SEGMENT

STG_CUSTOMERS = (
    "SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS name, "
    "c_mktsegment AS segment FROM customer"
)
STG_EVENTS = (
    "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS customer_id, "
    "event_type AS event_name, ts AS occurred_at FROM events"
)
STG_ORDERS = (
    "SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS amount, "
    "date_trunc('second', o_orderdate) AS ordered_at FROM orders"
)
AGG_EVENTS = (
    f"SELECT customer_id, count(*) AS event_count, max(occurred_at) AS last_event_at "
    f"FROM ({STG_EVENTS}) GROUP BY customer_id"
)
AGG_ORDERS = (
    f"SELECT customer_id, count(*) AS order_count, "
    f"CAST(sum(amount) AS DECIMAL(28,2)) AS lifetime_value, max(ordered_at) AS last_order_at "
    f"FROM ({STG_ORDERS}) GROUP BY customer_id"
)
MART = f"""
SELECT c.customer_id, c.name, c.segment,
       coalesce(e.event_count, 0) AS event_count, e.last_event_at,
       coalesce(o.order_count, 0) AS order_count,
       CAST(coalesce(o.lifetime_value, 0) AS DECIMAL(28,2)) AS lifetime_value,
       o.last_order_at
FROM ({STG_CUSTOMERS}) c
LEFT JOIN ({AGG_EVENTS}) e USING (customer_id)
LEFT JOIN ({AGG_ORDERS}) o USING (customer_id)
"""


def _over_mart(body: str, segment: str | None = None) -> str:
    where = "" if segment is None else f" WHERE segment = '{segment}'"
    return f"WITH mart AS ({MART}), m AS (SELECT * FROM mart{where}) {body}"


CARD_BODIES = {
    "card_total_customers": "SELECT count(*) AS customers FROM m",
    "card_active_customers": (
        "SELECT CAST(count_if(order_count > 0 OR event_count > 0) AS BIGINT) "
        "AS active_customers FROM m"
    ),
    "card_total_orders": "SELECT CAST(coalesce(sum(order_count), 0) AS BIGINT) AS orders FROM m",
    "card_lifetime_value": (
        "SELECT CAST(coalesce(sum(lifetime_value), 0) AS DOUBLE) AS lifetime_value FROM m"
    ),
    "card_ltv_by_segment": (
        "SELECT segment, CAST(sum(lifetime_value) AS DOUBLE) AS lifetime_value FROM m "
        "GROUP BY segment ORDER BY lifetime_value DESC"
    ),
    "card_activity_by_segment": (
        "SELECT segment, CAST(sum(order_count) AS BIGINT) AS orders, "
        "CAST(sum(event_count) AS BIGINT) AS events FROM m GROUP BY segment ORDER BY segment"
    ),
    "card_customer_detail": (
        "SELECT customer_id, name, segment, event_count, last_event_at, order_count, "
        "CAST(lifetime_value AS DOUBLE) AS lifetime_value, last_order_at FROM m "
        "ORDER BY lifetime_value DESC, customer_id"
    ),
}

_DAYS = "coalesce(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)), 0)"
SUITE_BODY = f"""
SELECT 0 AS card_position, 'Total Customers' AS card, 'scalar' AS display, CAST(1 AS BIGINT) AS row_count,
  CAST(count(*) AS DOUBLE) AS number_sum, CAST(0 AS BIGINT) AS text_length, CAST(0 AS BIGINT) AS day_sum FROM m
UNION ALL SELECT 1, 'Active Customers', 'scalar', 1, CAST(count_if(order_count > 0 OR event_count > 0) AS DOUBLE), 0, 0 FROM m
UNION ALL SELECT 2, 'Total Orders', 'scalar', 1, CAST(coalesce(sum(order_count), 0) AS DOUBLE), 0, 0 FROM m
UNION ALL SELECT 3, 'Lifetime Value', 'scalar', 1, CAST(coalesce(sum(lifetime_value), 0) AS DOUBLE), 0, 0 FROM m
UNION ALL SELECT 4, 'Lifetime Value by Segment', 'bar', count(DISTINCT coalesce(segment, '')),
  CAST(coalesce(sum(lifetime_value), 0) AS DOUBLE),
  CAST(coalesce((SELECT sum(length(segment)) FROM (SELECT DISTINCT segment FROM m)), 0) AS BIGINT), 0 FROM m
UNION ALL SELECT 5, 'Activity by Segment', 'bar', count(DISTINCT coalesce(segment, '')),
  CAST(coalesce(sum(order_count + event_count), 0) AS DOUBLE),
  CAST(coalesce((SELECT sum(length(segment)) FROM (SELECT DISTINCT segment FROM m)), 0) AS BIGINT), 0 FROM m
UNION ALL SELECT 6, 'Customer Detail', 'table', count(*),
  CAST(coalesce(sum(coalesce(customer_id, 0) + event_count + order_count + lifetime_value), 0) AS DOUBLE),
  CAST(coalesce(sum(coalesce(length(name), 0) + coalesce(length(segment), 0)), 0) AS BIGINT),
  CAST(coalesce(sum({_DAYS.format('last_event_at')} + {_DAYS.format('last_order_at')}), 0) AS BIGINT) FROM m
"""

NOT_NULL_SOURCES = """
SELECT 'not_null' AS test, 'customers' AS table_name, 'customer_id' AS column_name,
       CAST(count_if(c_custkey IS NULL) AS BIGINT) AS failures FROM customer
UNION ALL SELECT 'not_null', 'events', 'event_id', CAST(count_if(event_id IS NULL) AS BIGINT) FROM events
UNION ALL SELECT 'not_null', 'orders', 'order_id', CAST(count_if(o_orderkey IS NULL) AS BIGINT) FROM orders
"""
NOT_NULL_MART = """
SELECT 'not_null' AS test, 'customer_activity' AS table_name, 'customer_id' AS column_name,
       CAST(count_if(customer_id IS NULL) AS BIGINT) AS failures FROM mart
UNION ALL SELECT 'not_null', 'customer_activity', 'lifetime_value',
       CAST(count_if(lifetime_value IS NULL) AS BIGINT) FROM mart
"""
UNIQUE_MART = """
SELECT 'unique' AS test, 'customer_activity' AS table_name, 'customer_id' AS column_name,
       CAST(count(*) AS BIGINT) AS failures
FROM (SELECT customer_id FROM mart WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1)
"""
UNIQUE_EVENTS = """
SELECT 'unique' AS test, 'events' AS table_name, 'customer_id' AS column_name,
       CAST(count(*) AS BIGINT) AS failures
FROM (SELECT user_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)
"""

ORACLES: dict[str, str] = {
    "stg_customers": STG_CUSTOMERS,
    "stg_events": STG_EVENTS,
    "stg_orders": STG_ORDERS,
    "agg_events_by_customer": AGG_EVENTS,
    "agg_orders_by_customer": AGG_ORDERS,
    "join_left_using": (
        f"SELECT c.customer_id, c.name, c.segment, e.event_count, e.last_event_at "
        f"FROM ({STG_CUSTOMERS}) c LEFT JOIN ({AGG_EVENTS}) e USING (customer_id)"
    ),
    "customer_activity": MART,
    "report_suite": _over_mart(SUITE_BODY),
    "report_suite_filtered": _over_mart(SUITE_BODY, FILTER_SEGMENT),
    "dq_not_null": f"WITH mart AS ({MART}) {NOT_NULL_SOURCES} UNION ALL {NOT_NULL_MART}",
    "dq_unique": f"WITH mart AS ({MART}) {UNIQUE_MART} UNION ALL {UNIQUE_EVENTS}",
    "dq_build": (
        f"WITH mart AS ({MART}), r AS ({NOT_NULL_SOURCES} UNION ALL {NOT_NULL_MART} "
        f"UNION ALL {UNIQUE_MART}) SELECT *, failures = 0 AS passed FROM r"
    ),
    "dq_suite": (
        f"WITH mart AS ({MART}), r AS ({NOT_NULL_SOURCES} UNION ALL {NOT_NULL_MART} "
        f"UNION ALL {UNIQUE_MART}) SELECT *, failures = 0 AS passed FROM r"
    ),
}
for _key, _body in CARD_BODIES.items():
    ORACLES[_key] = _over_mart(_body)
    ORACLES[f"{_key}_filtered"] = _over_mart(_body, FILTER_SEGMENT)
ORACLES["card_total_orders_unknown_segment"] = _over_mart(
    CARD_BODIES["card_total_orders"], UNKNOWN_SEGMENT
)
ORACLES["card_lifetime_value_unknown_segment"] = _over_mart(
    CARD_BODIES["card_lifetime_value"], UNKNOWN_SEGMENT
)


# -- scenarios: scans, ingestion, loads, normalization, ad-hoc SQL -----------------

_O = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount, "
    "o_orderdate AS ordered_at FROM orders"
)
_FIRST = "o_orderdate < TIMESTAMP '1998-01-01'"
_SECOND = "o_orderdate >= TIMESTAMP '1997-01-01'"
_THIRD = "o_orderdate >= TIMESTAMP '1999-01-01'"

SCENARIO_ORACLES = {
    "scan_csv": STG_CUSTOMERS,
    "scan_csv_gz": STG_CUSTOMERS,
    "scan_json": STG_EVENTS,
    "scan_json_records_path": STG_EVENTS,
    "scan_jsonl": STG_EVENTS,
    "scan_parquet": STG_ORDERS,
    "scan_glob_recursive": STG_EVENTS,
    "ingest_multi_table": MART,
    "ingest_api_pages": (
        "SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id, "
        "CAST(o_totalprice AS DECIMAL(18,2)) AS amount, date_trunc('second', o_orderdate) AS ordered_at, "
        "o_orderkey // 1000 AS _page, "
        "CAST(row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS BIGINT) "
        "AS _page_pos FROM orders"
    ),
    "load_append": f"{_O} WHERE {_FIRST} UNION ALL {_O} WHERE {_SECOND}",
    "load_replace": f"{_O} WHERE {_SECOND}",
    "load_replay": f"""
        WITH v AS (
          SELECT * FROM ({_O} WHERE {_FIRST})
          UNION ALL SELECT * REPLACE (amount + 1 AS amount) FROM ({_O} WHERE NOT ({_FIRST})))
        SELECT v.*, t.loaded_into FROM v, (VALUES ('plain'), ('keyed')) AS t(loaded_into)""",
    "load_merge": f"""
        WITH v AS (
          SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
                 o_orderdate AS ordered_at, 1 AS seq FROM orders WHERE {_FIRST}
          UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate, 2 FROM orders WHERE {_SECOND}
          UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 2, o_orderdate, 3 FROM orders WHERE {_THIRD})
        SELECT order_id, customer_id, amount, ordered_at, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) AS rn FROM v) WHERE rn = 1
    """,
    "load_insert_ignore": f"""
        {_O} WHERE {_FIRST}
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderdate FROM orders
        WHERE {_SECOND} AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {_FIRST})
    """,
    "load_schema_evolution": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
               o_orderdate AS ordered_at, CAST(NULL AS VARCHAR) AS priority FROM orders WHERE {_FIRST}
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE {_SECOND}
    """,
    "load_type_conflict": f"""
        SELECT o_orderkey AS order_id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS amount__v_string
        FROM orders WHERE {_FIRST}
        UNION ALL SELECT o_orderkey,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' END
        FROM orders WHERE {_SECOND}
    """,
    "load_incremental_cursor": _O,
    "load_incremental_files": _O,
    "load_audit": f"""
        WITH n1 AS (SELECT count(*) AS n FROM orders WHERE {_FIRST}),
             n2 AS (SELECT count(*) AS n FROM orders WHERE {_SECOND})
        SELECT CAST(1 AS BIGINT) AS load_seq, 'orders' AS table_name, 'append' AS disposition,
               n1.n AS rows_in, n1.n AS rows_loaded FROM n1
        UNION ALL SELECT 2, 'orders', 'append', n2.n, n2.n FROM n2
        UNION ALL SELECT 3, 'orders', 'replace', n2.n, n2.n FROM n2
        UNION ALL SELECT 4, 'orders', 'merge', n1.n, n1.n FROM n1
    """,
    "load_log_replay": f"""
        WITH o AS ({_O}),
             v AS (
          SELECT n AS load_seq, order_id, amount FROM o, range(1, 7) AS r(n) WHERE order_id % 6 < n
          UNION ALL SELECT n, order_id, CASE WHEN order_id % 2 = 0 THEN amount + 1 ELSE amount END
                    FROM o, range(7, 9) AS r(n)
          UNION ALL SELECT 9, order_id, amount FROM o WHERE order_id % 3 = 0)
        SELECT load_seq, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS order_ids,
               CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM v GROUP BY load_seq""",
    "load_compact": f"SELECT o.*, s.state FROM ({_O}) AS o, (VALUES ('before'), ('after')) AS s(state)",
    "load_merge_few_keys": f"""
        WITH o AS ({_O}), few AS (SELECT max(order_id) AS order_id FROM o GROUP BY order_id % 5)
        SELECT order_id, customer_id, CASE WHEN order_id IN (SELECT order_id FROM few) THEN 0.0 ELSE amount END AS amount,
               ordered_at FROM o""",
    "dq_unique_buckets": f"""
        WITH mart AS ({MART}),
             v AS (SELECT run, customer_id FROM mart, range(1, 4) AS r(run)
                   UNION ALL SELECT 2, customer_id FROM mart WHERE customer_id % 7 = 0),
             k AS (SELECT run, customer_id, count(*) AS n FROM v WHERE customer_id IS NOT NULL GROUP BY ALL)
        SELECT 'unique' AS test, 'customer_activity' AS table_name, 'customer_id' AS column_name,
               CAST(count(*) FILTER (n > 1) AS BIGINT) AS failures, run FROM k GROUP BY run""",
    "mart_materialized": MART,
    "normalize_names": (
        "SELECT c_custkey AS cust_key, c_name AS customer_name, c_nationkey AS nation_key, "
        "c_acctbal AS account_balance, c_mktsegment AS mkt_segment FROM customer"
    ),
    "normalize_flatten": (
        "SELECT event_id, ts, user_id, event_type, value, "
        "CAST(json_extract(props, '$.k') AS BIGINT) AS props__k FROM events"
    ),
    "normalize_child_table": """
        WITH c AS (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations),
             e AS (SELECT conv_id, turn, parts, unnest(generate_series(1, len(parts))) AS i FROM c)
        SELECT conv_id, turn, CAST(i - 1 AS BIGINT) AS _idx, parts[i] AS value,
               sha256(length(CAST(conv_id AS VARCHAR)) || ':' || conv_id || ';'
                      || length(CAST(turn AS VARCHAR)) || ':' || turn || ';'
                      || length(CAST(i - 1 AS VARCHAR)) || ':' || (i - 1) || ';') AS _row_key
        FROM e
    """,
    "ingest_child_tables": """
        WITH c AS (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations),
             e AS (SELECT conv_id, turn, parts, unnest(generate_series(1, len(parts))) AS i FROM c)
        SELECT conv_id, turn, CAST(i - 1 AS BIGINT) AS _idx, parts[i] AS value FROM e
    """,
    "adhoc_sum": (
        "SELECT count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS custkey_sum, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders"
    ),
    "adhoc_preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 20",
    "adhoc_sum_by_customer": (
        "SELECT o_custkey AS customer_id, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount "
        "FROM orders GROUP BY o_custkey"
    ),
    "adhoc_param_sql": (
        f"WITH mart AS ({MART}) SELECT segment, count(*) AS customers, "
        "CAST(sum(lifetime_value) AS DOUBLE) AS lifetime_value FROM mart "
        "WHERE segment = 'BUILDING' GROUP BY segment"
    ),
    "fn_parse_datetime": "SELECT o_orderkey, o_orderpriority, o_orderdate AS parsed_at FROM orders",
}
ORACLES.update(SCENARIO_ORACLES)

ORACLES |= {
    "fn_parse_datetime_compact": (
        "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) "
        "WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 36930 SECOND "
        "ELSE make_timestamp((1600000000 + o_orderkey) * 1000000) END AS parsed_at FROM orders"
    ),
    "adhoc_json_long_line": (
        "SELECT CAST(count(*) + 1 AS BIGINT) AS n, CAST(sum(length(text)) + 100000 AS BIGINT) AS chars "
        "FROM documents"
    ),
    "load_type_narrowing": (
        "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 THEN NULL "
        "ELSE CAST(o_custkey AS BIGINT) END AS v, CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 "
        "THEN CAST(o_custkey AS DOUBLE) + 0.75 END AS v__v_double FROM orders"
    ),
    "load_cursor_ties_no_key": (
        "WITH e AS (SELECT event_id, date_trunc('day', ts) AS day FROM events), "
        "m AS (SELECT max(day) AS mark FROM e WHERE event_id % 3 <> 0) "
        "SELECT event_id, CAST(day AS TIMESTAMP) AS day FROM e, m WHERE event_id % 3 <> 0 OR day >= mark"
    ),
    "scan_csv_quoted": (
        "SELECT o_orderkey, 'say \"hi\", ' || o_orderpriority || chr(10) || 'second line' AS note FROM orders"
    ),
    "scan_glob_residual": "SELECT event_id, user_id FROM events WHERE event_id % 2 = 0",
    "ingest_grandchildren_shrink": """
        WITH g AS (
          SELECT o_orderkey AS order_id, o_orderstatus, o_orderpriority, o_orderkey % 2 = 0 AS again, name, rank
          FROM orders, (VALUES ('a', 1), ('b', 2)) AS v(name, rank))
        SELECT order_id, name, CAST(0 AS BIGINT) AS position, o_orderstatus AS value FROM g
        WHERE NOT again OR rank <= order_id % 3
        UNION ALL SELECT order_id, name, 1, o_orderpriority FROM g WHERE NOT again""",
    "ingest_child_shrink": (
        "SELECT o_orderkey AS order_id, CAST(0 AS BIGINT) AS _idx, o_orderpriority AS value FROM orders "
        "WHERE o_orderkey % 2 = 1"
    ),
    "ingest_child_duplicate_parents": (
        "SELECT o_orderkey AS order_id, CAST(0 AS BIGINT) AS _idx, o_orderstatus AS value FROM orders"
    ),
}

ORACLES["ingest_connector"] = ORACLES["ingest_api_pages"]  # the same rows by another reader
