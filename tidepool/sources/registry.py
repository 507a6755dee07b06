"""Connector registry: source type -> reader producing named tables.

A reader takes the session and a :class:`~tidepool.spec.SourceSpec` and returns
``{table name: TableRead}`` -- lazy DataFrames plus the load hints of each table.
New source types register with :func:`register_reader`.  Classes of Spark's Python Data Source API
are plugged in without one: a source of type ``connector`` names them, and each of its tables is
read by the class's format name.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import scratch_dir
from tidepool.sources import api_pages, jdbc
from tidepool.sources.documents import read_json_documents
from tidepool.sources.files import join_path, read_files
from tidepool.sources.objectstore import s3a_options, s3a_path
from tidepool.spec import InvalidSpec, Field, SourceSpec, require_valid


@dataclass(frozen=True)
class TableRead:
    df: DataFrame
    primary_key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    cursor: str | None = None
    buckets: int | None = None
    staging: str | None = None  # folder that the rows are read from, deleted when they are loaded


ReaderFn = Callable[[SparkSession, SourceSpec], dict[str, TableRead]]
_READERS: dict[str, ReaderFn] = {}

# File formats of filesystem tables.
FILE_FORMATS = ("csv", "json", "jsonl", "parquet")


def register_reader(source_type: str) -> Callable[[ReaderFn], ReaderFn]:
    def wrap(fn: ReaderFn) -> ReaderFn:
        _READERS[source_type] = fn
        return fn

    return wrap


def supported_types() -> list[str]:
    return sorted(_READERS)


def build_reader(spec: SourceSpec) -> ReaderFn:
    try:
        return _READERS[spec.type]
    except KeyError:
        known = ", ".join(supported_types())
        raise InvalidSpec(f"{spec.name}: no reader for type {spec.type}; there are {known}") from None


def read_source(spark: SparkSession, spec: SourceSpec) -> dict[str, TableRead]:
    return build_reader(spec)(spark, spec)


def _hints(spec: SourceSpec, table: dict) -> dict:
    pk = table.get("primary_key", spec.options.get("primary_key")) or ()
    order = table.get("order_by", spec.options.get("order_by")) or ()
    endpoint = table.get("endpoint") if isinstance(table.get("endpoint"), dict) else {}
    incremental = endpoint.get("incremental") or table.get("incremental") or {}
    if isinstance(incremental, dict) and incremental.get("cursor_path") and not table.get("cursor"):
        table = {**table, "cursor": incremental["cursor_path"]}
    return {
        "primary_key": tuple([pk] if isinstance(pk, str) else pk),
        "order_by": tuple([order] if isinstance(order, str) else order),
        "cursor": table.get("cursor", spec.options.get("cursor")),
        "buckets": table.get("buckets", spec.options.get("buckets")),
    }


# What each type of source declares, beyond the fields that all sources share.
FILESYSTEM_FIELDS = {
    "bucket_url": Field(required=True),
    "credentials": Field(dict),
    "tables": Field(
        list,
        required=True,
        entries={
            "name": Field(required=True),
            "file_glob": Field(required=True),
            "format": Field(required=True, choices=FILE_FORMATS),
            "options": Field(dict),
        },
    ),
}
DATABASE_FIELDS = {
    "engine": Field(required=True, choices=tuple(jdbc.ENGINES)),
    "credentials_env": Field(required=True),
    "table_names": Field(list, required=True, entries={"name": Field(required=True)}, plain_entries=True),
    "chunk_size": Field(int),
    "include_views": Field(bool),
    "partitioning": Field(dict),
}
CONNECTOR_FIELDS = {
    "connector": Field(required=True),
    "options": Field(dict),
    "tables": Field(list, required=True, entries={"name": Field(required=True), "options": Field(dict)}),
}
API_FIELDS = {
    "landing_url": Field(),
    "base_url": Field(),
    "resources": Field(list, required=True, entries={"name": Field(required=True)}),
}


@register_reader("filesystem")
def filesystem_reader(spark: SparkSession, spec: SourceSpec) -> dict[str, TableRead]:
    """Files under one base folder or bucket; ``options`` of a table go to Spark's reader."""
    require_valid(spec.options, FILESYSTEM_FIELDS, spec.name)
    store = s3a_options(spec.options.get("credentials"))
    base = s3a_path(spec.options["bucket_url"])

    def read(table: dict) -> TableRead:
        place = join_path(base, table["file_glob"])
        options = store | {k: str(v) for k, v in (table.get("options") or {}).items()}
        schema, staging = table.get("schema"), None
        if table["format"] == "json":
            staging = scratch_dir(spark, "documents")
            path = table.get("records_path")
            df = read_json_documents(spark, place, path, schema=schema, options=options, staging=staging)
        else:
            df = read_files(spark, place, table["format"], schema=schema, options=options)
        return TableRead(df, **_hints(spec, table), staging=staging)

    return {t["name"]: read(t) for t in spec.options["tables"]}


@register_reader("database")
def database_reader(spark: SparkSession, spec: SourceSpec) -> dict[str, TableRead]:
    """Database tables by name, and views with ``include_views``; an entry may be a mapping with its
    own key and order.  ``partitioning`` gives a table's range ``columns`` or numeric ``column``."""
    opts = spec.options
    require_valid(opts, DATABASE_FIELDS, spec.name)
    url = os.environ.get(opts["credentials_env"])
    if url is None:
        raise InvalidSpec(f"{spec.name}: the environment has no {opts['credentials_env']}")
    engine, schema = opts["engine"], opts.get("schema")
    connection = jdbc.jdbc_connection(engine, url)
    partitioning = opts.get("partitioning") or {}
    tables = [t if isinstance(t, dict) else {"name": t} for t in opts["table_names"]]
    names = [t["name"] for t in tables]
    kinds = jdbc.relation_types(spark, connection, engine, schema, names)
    if missing := [n for n in names if n not in kinds]:
        raise InvalidSpec(f"{spec.name}: the database has no {', '.join(missing)}")
    views = [n for n in names if kinds[n] != jdbc.TABLE]
    if views and not opts.get("include_views"):
        raise InvalidSpec(f"{spec.name}: {', '.join(views)} are views; set include_views to read them")

    def read(table: dict) -> DataFrame:
        name = table["name"]
        cut = partitioning.get(name) or {}
        place = jdbc.qualified(name, schema)
        chunk_size = opts.get("chunk_size") or jdbc.DEFAULT_CHUNK_SIZE
        if cut.get("column"):
            return jdbc.read_jdbc_table(
                spark, connection, place, chunk_size, cut["column"], cut.get("num_partitions")
            )
        columns = list(cut.get("columns") or _hints(spec, table)["primary_key"])
        if not columns and kinds[name] == jdbc.TABLE:
            columns = jdbc.key_columns(spark, connection, engine, schema, name)
        if not columns:  # nothing to cut it by
            return jdbc.read_jdbc_table(spark, connection, place, chunk_size)
        return jdbc.read_jdbc_ranges(
            spark, connection, engine, place, columns, chunk_size, cut.get("num_partitions")
        )

    return {t["name"]: TableRead(read(t), **_hints(spec, t)) for t in tables}


@register_reader("connector")
def connector_reader(spark: SparkSession, spec: SourceSpec) -> dict[str, TableRead]:
    """Tables of a Python data source, ``connector: package.module:Class``.

    The class is registered with the session and read by its format name; ``options`` of the
    source and of a table go to it.  A table's ``schema`` parses its column ``record`` of JSON text.
    """
    require_valid(spec.options, CONNECTOR_FIELDS, spec.name)
    module, _, name = spec.options["connector"].partition(":")
    try:
        source = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as problem:
        raise InvalidSpec(f"{spec.name}: no connector {spec.options['connector']} ({problem})") from None
    spark.dataSource.register(source)

    def read(table: dict) -> DataFrame:
        options = {**(spec.options.get("options") or {}), **(table.get("options") or {})}
        df = spark.read.format(source.name()).options(**{k: str(v) for k, v in options.items()}).load()
        if not table.get("schema"):
            return df
        parsed = F.from_json("record", table["schema"], {"mode": "FAILFAST"})
        return df.select(parsed.alias("r"), *[c for c in df.columns if c != "record"]).select(
            "r.*", *[c for c in df.columns if c != "record"]
        )

    return {t["name"]: TableRead(read(t), **_hints(spec, t)) for t in spec.options["tables"]}


@register_reader("api")
def api_reader(spark: SparkSession, spec: SourceSpec) -> dict[str, TableRead]:
    """Resources whose response pages were landed below ``landing_url`` (or ``base_url``)."""
    require_valid(spec.options, API_FIELDS, spec.name)
    landing = spec.options.get("landing_url") or spec.options.get("base_url")
    if not landing:
        raise InvalidSpec(f"{spec.name}.landing_url is missing")

    def read(resource: dict) -> TableRead:
        endpoint = resource.get("endpoint")
        endpoint = endpoint if isinstance(endpoint, dict) else {}
        staging = scratch_dir(spark, "documents")
        df = api_pages.read_resource(
            spark,
            s3a_path(landing),
            endpoint.get("path", resource["name"]),
            data_selector=endpoint.get("data_selector"),
            schema=resource.get("schema"),
            staging=staging,
        )
        return TableRead(df, **_hints(spec, resource), staging=staging)

    return {r["name"]: read(r) for r in spec.options["resources"]}
