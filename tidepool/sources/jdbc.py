"""Relational tables over JDBC (PostgreSQL, MySQL), one DataFrame per table.

The reader fetches in batches of ``chunk_size`` rows (JDBC ``fetchsize``).  A table with a key
(declared, or found in the database's catalogue) is read by parallel range queries whose bounds are
quantiles of the key, taken by the database: ranges hold about equally many rows whatever the
values are, and keys may be text or of several columns.  Every row is in one range, those with a
NULL in the key in the first.  With a numeric ``partition_column`` the table is read by
equal steps between its minimum and maximum instead.  Filters and
column pruning on the returned DataFrame are pushed into the SQL sent to the
database.  The JDBC driver jar of the engine must be on the classpath.
"""

from __future__ import annotations

import datetime as dt
import decimal
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

# URL schemes and driver classes per engine; default fetch size.
ENGINES = {
    "postgresql": ("jdbc:postgresql", "org.postgresql.Driver", 5432),
    "mysql": ("jdbc:mysql", "com.mysql.cj.jdbc.Driver", 3306),
}
DEFAULT_CHUNK_SIZE = 50_000


def jdbc_connection(engine: str, url: str) -> dict[str, str]:
    """``postgresql://user:pw@host:port/db`` -> JDBC url, user, password, driver."""
    if engine not in ENGINES:
        raise ValueError(f"engine must be one of {', '.join(sorted(ENGINES))}")
    if url.startswith("jdbc:"):
        return {"url": url, "driver": ENGINES[engine][1]}
    prefix, driver, default_port = ENGINES[engine]
    parts = urlsplit(url)
    host = parts.hostname or "localhost"
    port = parts.port or default_port
    database = parts.path.lstrip("/")
    conn = {"url": f"{prefix}://{host}:{port}/{database}", "driver": driver}
    if parts.username:
        conn["user"] = unquote(parts.username)
    if parts.password:
        conn["password"] = unquote(parts.password)
    return conn


def qualified(table: str, schema: str | None) -> str:
    return f"{schema}.{table}" if schema else table


# -- the database's catalogue -----------------------------------------------------------

# How each engine calls the schema in use, and what the standard calls its relations.
CURRENT_SCHEMA = {"postgresql": "current_schema()", "mysql": "DATABASE()"}
TABLE, VIEW = "BASE TABLE", "VIEW"


def _query(spark: SparkSession, connection: dict[str, str], sql: str) -> list:
    return spark.read.format("jdbc").options(**connection).option("query", sql).load().collect()


def _text(value: str, engine: str) -> str:
    value = value.replace("\\", "\\\\") if engine == "mysql" else value
    return "'" + value.replace("'", "''") + "'"


def _within(engine: str, schema: str | None) -> str:
    return _text(schema, engine) if schema else CURRENT_SCHEMA[engine]


def relation_types(
    spark: SparkSession, connection: dict[str, str], engine: str, schema: str | None, names: list[str]
) -> dict[str, str]:
    """The kind (``BASE TABLE``, ``VIEW``) of every relation of ``names`` that there is."""
    rows = _query(
        spark,
        connection,
        "SELECT table_name AS name, table_type AS kind FROM information_schema.tables "
        f"WHERE table_schema = {_within(engine, schema)} AND table_name IN ({', '.join(_text(n, engine) for n in names)})",
    )
    return {r[0]: r[1] for r in rows}


def key_columns(
    spark: SparkSession, connection: dict[str, str], engine: str, schema: str | None, table: str
) -> list[str]:
    """The columns of a table's primary key, in order; none if it has no such key."""
    rows = _query(
        spark,
        connection,
        "SELECT k.column_name AS name, k.ordinal_position AS place FROM information_schema.table_constraints c "
        "JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
        "AND k.table_schema = c.table_schema AND k.table_name = c.table_name "
        f"WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = {_within(engine, schema)} "
        f"AND c.table_name = {_text(table, engine)}",
    )
    return [r[0] for r in sorted(rows, key=lambda r: r[1])]


# -- ranges of a key --------------------------------------------------------------------


def quantile_query(table: str, columns: list[str], parts: int) -> str:
    """SQL of the first key of each of about ``parts`` equally long runs of a table in key order."""
    names = ", ".join(columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place_, "
        f"COUNT(*) OVER () AS rows_ FROM {table} WHERE {present}) ranked_ "
        f"WHERE MOD(place_ - 1, (rows_ + {parts - 1}) / {parts}) < 1 ORDER BY place_"
    )


def _literal(value, engine: str) -> str:
    if isinstance(value, str):
        return _text(value, engine)
    if isinstance(value, (dt.datetime, dt.date)):
        return "'" + str(value) + "'"
    if isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"a key of type {type(value).__name__} has no ranges")


def _at_least(columns: list[str], bound: tuple, engine: str) -> str:
    """Whether a key is ``bound`` or later, column by column."""
    out = f"{columns[-1]} >= {_literal(bound[-1], engine)}"
    for column, value in zip(reversed(columns[:-1]), reversed(bound[:-1])):
        out = f"({column} > {(v := _literal(value, engine))} OR ({column} = {v} AND {out}))"
    return out


def range_predicates(columns: list[str], bounds: list[tuple], engine: str) -> list[str]:
    """Predicates that hold every row once: before the first inner bound, between neighbours,
    from the last on.  ``bounds`` are keys in order; equal ones count once."""
    cuts = list(dict.fromkeys(tuple(b) for b in bounds))[1:]
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    absent = " OR ".join(f"{c} IS NULL" for c in columns)
    if not cuts:
        return ["1 = 1"]
    starts = [_at_least(columns, c, engine) for c in cuts]
    out = [f"{absent} OR NOT ({starts[0]})"]
    out += [f"{present} AND {a} AND NOT ({b})" for a, b in zip(starts, starts[1:])]
    return [*out, f"{present} AND {starts[-1]}"]


def read_jdbc_ranges(
    spark: SparkSession,
    connection: dict[str, str],
    engine: str,
    table: str,
    columns: list[str],
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    num_partitions: int | None = None,
) -> DataFrame:
    """A table by ranges of equally many rows of its key ``columns``, one task each."""
    parts = num_partitions or spark.sparkContext.defaultParallelism
    bounds = [tuple(r) for r in _query(spark, connection, quantile_query(table, columns, parts))]  # about ``parts``
    options = {k: v for k, v in connection.items() if k != "url"} | {"fetchsize": str(chunk_size)}
    predicates = range_predicates(columns, bounds, engine)
    return spark.read.jdbc(connection["url"], table, predicates=predicates, properties=options)


# -- tables -----------------------------------------------------------------------------


def read_jdbc_table(
    spark: SparkSession,
    connection: dict[str, str],
    table: str,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    partition_column: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    def reader():  # a fresh reader per read: option() mutates the reader it returns
        return spark.read.format("jdbc").options(**connection).option("fetchsize", str(chunk_size))

    if not partition_column:
        return reader().option("dbtable", table).load()
    bounds = (
        reader()
        .option(
            "query",
            f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}",
        )
        .load()
        .first()
    )
    if bounds is None or bounds[0] is None:
        return reader().option("dbtable", table).load()
    return (
        reader()
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism))
        .load()
    )
