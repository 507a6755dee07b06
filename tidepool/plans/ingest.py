"""Ingestion: read every table of an enabled source, normalize it and load it into
the warehouse with the source's write disposition, one audit record per table.

Normalization follows the loader conventions: snake_case names, nested objects
flattened to ``parent__child`` columns, and every list column moved to a child table
``<table>__<column>`` (recursively) that references its parent row by
``_parent_key``; tables further down carry the key of the outermost parent, too
(``_root_key``).  Child tables follow the parent's disposition; for a merged parent
all elements of each incoming parent, at every depth, replace the stored ones
(delete-insert by that key), so a list that shrinks leaves no stale elements behind.

Merged tables are stored and moved by what their keys derive from -- the outermost parent's primary
key and positions in lists -- not by the keys of 64 characters, which reads of them derive again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, IntegralType, StringType

from tidepool.operators.incremental import pending_rows
from tidepool.operators.load import LoadResult, Warehouse, dedupe_last
from tidepool.operators.normalize import (
    CHILD_INDEX,
    NESTING_SEPARATOR,
    PARENT_KEY,
    ROOT_KEY,
    ROW_KEY,
    child_table,
    flatten,
    row_key,
    snake_case,
)
from tidepool.session import delete_path, scratch_dir
from tidepool.sources.registry import TableRead, read_source
from tidepool.spec import SourceSpec

CHILD_DISPOSITION = {
    "append": "append",
    "replace": "replace",
    "merge": "delete_insert",
    "insert_ignore": "insert_ignore",
}


@dataclass(frozen=True)
class IngestReport:
    source: str
    connector: str
    dataset: str
    loads: list[LoadResult]


@dataclass(frozen=True)
class TableLoad:
    name: str
    df: DataFrame
    primary_key: tuple[str, ...]
    child: bool
    row_keys: dict | None = None


def column_name(path: str) -> str:
    """The loaded column of a (dotted) source field: ``meta.UpdatedAt`` -> ``meta__updated_at``."""
    return NESTING_SEPARATOR.join(snake_case(part) for part in path.split("."))


def split_tables(
    name: str, df: DataFrame, primary_key: tuple[str, ...], flat: bool = False
) -> list[TableLoad]:
    """The parent table without list columns, plus one child table per list column
    (recursively for lists inside list elements)."""
    df = df if flat else flatten(df)
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    if not lists:
        return [TableLoad(name, df, primary_key, False)]
    if ROW_KEY in df.columns:  # a child table: its rows are keyed already
        keyed = df
    elif primary_key:
        keyed = df.withColumn(ROW_KEY, row_key(*primary_key))
    else:  # content key: deterministic, unlike generated ids
        content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        keyed = df.withColumn(ROW_KEY, F.sha2(content, 256))
    out = [TableLoad(name, keyed.drop(*lists), primary_key, False)]
    below = ROW_KEY in df.columns  # lists in list elements
    for col in lists:
        child_name = f"{name}__{col}"
        root = [F.col(ROOT_KEY if ROOT_KEY in df.columns else PARENT_KEY).alias(ROOT_KEY)] if below else []
        parent = keyed.select(F.col(ROW_KEY).alias(PARENT_KEY), *root, F.col(f"`{col}`"))
        child = child_table(parent, [PARENT_KEY], col, [ROOT_KEY] if below else [])
        key = (ROOT_KEY,) if below else (PARENT_KEY,)
        for sub in split_tables(child_name, child, (), flat=True):
            out.append(TableLoad(sub.name, sub.df, key if sub.name == child_name else sub.primary_key, True))
    return out


def split_positions(
    name: str, df: DataFrame, root: tuple[str, ...], at: tuple[str, ...] = (), child: bool = False
) -> list[TableLoad]:
    """The tables of :func:`split_tables`, in its order, with the columns that their keys derive from
    instead of the keys (``normalize.with_keys``).  No normalized name starts like these columns'."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    out = [TableLoad(name, df.drop(*lists), root, child, {"root": [*root], "at": [*at], "child": child})]
    below = tuple(f"__root_{i}" for i in range(len(root)))
    place = (*at, f"__at_{len(at)}") if child else ()
    for col in lists:
        parent = df.select(
            *[F.col(f"`{k}`").alias(b) for k, b in zip(root, below)],
            *[F.col(CHILD_INDEX if a == place[-1] else a).alias(a) for a in place],
            F.col(f"`{col}`"),
        )
        rows = child_table(parent, [*below, *place], col)
        out += split_positions(f"{name}__{col}", rows.select(*rows.columns[:-1]), below, place, True)
    return out


def _derivable(df: DataFrame, primary_key: tuple[str, ...]) -> bool:
    """Whether the keys can be derived again: from values whose text no setting changes."""
    if {ROW_KEY, PARENT_KEY, ROOT_KEY} & set(df.columns):
        return False
    types = [df.schema[k].dataType for k in primary_key]
    return all(isinstance(t, (IntegralType, BooleanType, DateType)) or t == StringType() for t in types)


def load_table(
    warehouse: Warehouse, spec: SourceSpec, table: str, read: TableRead, normalize: bool = True
) -> list[LoadResult]:
    df = flatten(read.df) if normalize and read.df.columns else read.df
    named = column_name if normalize else str
    cursor = named(read.cursor) if read.cursor else None
    primary_key = tuple(named(k) for k in read.primary_key)
    order_by = tuple(named(c) for c in read.order_by)
    if cursor:  # incremental: only rows at or after the table's high-water mark
        df = pending_rows(df, warehouse, spec.dataset_name, table, cursor, primary_key)
    keyed_merge = spec.write_disposition == "merge" and bool(primary_key)
    lists = any(isinstance(f.dataType, ArrayType) for f in df.schema.fields)
    if not (normalize and keyed_merge and lists):
        return _load_parts(warehouse, spec, table, read, df, primary_key, order_by, cursor, normalize)
    # only the winners' lists move; written once, since each of the tables reads them
    path = scratch_dir(warehouse.spark, "winners")
    try:
        dedupe_last(df, primary_key, order_by).write.parquet(path)
        df = warehouse.spark.read.schema(df.schema).parquet(path)
        return _load_parts(warehouse, spec, table, read, df, primary_key, order_by, cursor, normalize, deduped=True)
    finally:
        delete_path(warehouse.spark, path)


def _load_parts(
    warehouse: Warehouse, spec: SourceSpec, table: str, read: TableRead, df: DataFrame, primary_key: tuple[str, ...],
    order_by: tuple[str, ...], cursor: str | None, normalize: bool, deduped: bool = False,
) -> list[LoadResult]:
    keyed_merge = spec.write_disposition == "merge" and bool(primary_key)
    if normalize and df.columns:
        parts = split_tables(table, df, primary_key, flat=True)
    else:
        parts = [TableLoad(table, df, primary_key, False)]
    stored = parts
    if keyed_merge and len(parts) > 1 and not warehouse.catalog and _derivable(df, primary_key):
        stored = split_positions(table, df, primary_key)
    results = []
    for part, short in zip(parts, stored, strict=True):
        st = warehouse.state(spec.dataset_name, part.name)
        if st is None or st.row_keys == short.row_keys:  # a table keeps the form it has
            part = short
        delete_keys = None
        if part.child and keyed_merge:  # lists of incoming parents are replaced whole, empty ones included
            named = [F.col(f"`{k}`") for k in primary_key]
            if not part.row_keys:
                named = [row_key(*named)]
            delete_keys = df.select(*[c.alias(k) for c, k in zip(named, part.primary_key, strict=True)])
        disposition = spec.write_disposition
        if part.child:
            disposition = CHILD_DISPOSITION[disposition]
        results.append(
            warehouse.load(
                part.df,
                spec.dataset_name,
                part.name,
                disposition,
                primary_key=part.primary_key or None,
                order_by=() if part.child else order_by,
                cursor_column=None if part.child else cursor,
                source=spec.name,
                buckets=read.buckets,
                dedupe=not (part.child or deduped),
                delete_keys=delete_keys,
                row_keys=part.row_keys,
            )
        )
    return results


def ingest(
    spark: SparkSession, spec: SourceSpec, warehouse: Warehouse, normalize: bool = True
) -> IngestReport:
    if not spec.enabled:
        return IngestReport(spec.name, spec.type, spec.dataset_name, [])
    loads = []
    for table, read in read_source(spark, spec).items():
        try:
            loads.extend(load_table(warehouse, spec, table, read, normalize))
        finally:
            if read.staging:
                delete_path(spark, read.staging)
    return IngestReport(spec.name, spec.type, spec.dataset_name, loads)


def ingest_all(spark: SparkSession, specs: list[SourceSpec], warehouse: Warehouse) -> list[IngestReport]:
    return [ingest(spark, s, warehouse) for s in specs if s.enabled]
