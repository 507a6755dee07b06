"""Incremental loads driven by a cursor column.

The high-water mark is the ``cursor_max`` of the table's last load (from its log).  The
next load reads only ``cursor IS NULL OR cursor >= high-water mark`` -- a plain
predicate that Parquet and JDBC scans receive as a pushed filter, so row groups before the mark
without NULLs are not read -- and, because rows equal to the mark may already be loaded,
drops rows that the table already holds at or after the mark (a bounded tail, not the whole
table): by key, or by the whole row where there is no key.  A row without cursor value has no place
in the order and stops the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.load import LoadResult, Warehouse


def pending_rows(
    source: DataFrame,
    warehouse: Warehouse,
    dataset: str,
    table: str,
    cursor: str,
    primary_key: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    problem = F.raise_error(F.lit(f"NULL cursor {cursor} in a load into {dataset}.{table}"))
    placed = F.when(F.col(cursor).isNull(), problem.cast("boolean")).otherwise(F.lit(True))
    st = warehouse.state(dataset, table)
    if st is None or st.cursor_max is None:
        return source.where(placed)
    mark = F.lit(st.cursor_max).cast(source.schema[cursor].dataType)
    # the first filter is pushed into the scan; NULL rows pass it only to raise in the second
    fresh = source.where(F.col(cursor).isNull() | (F.col(cursor) >= mark)).where(placed)
    if not primary_key:
        loaded = warehouse.read(dataset, table)
        shared = [c for c in source.columns if c in loaded.columns]
        row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in shared])), 256)
        tail = loaded.where(F.col(cursor) >= mark).select(row.alias("__row")).distinct()
        fresh = fresh.withColumn("__row", row).join(tail, "__row", "left_anti").drop("__row")
    else:
        tail = warehouse.read(dataset, table).where(F.col(cursor) >= mark).select(*primary_key)
        fresh = fresh.join(tail, list(primary_key), "left_anti")
    return fresh


def load_incremental(
    source: DataFrame,
    warehouse: Warehouse,
    dataset: str,
    table: str,
    cursor: str,
    primary_key: tuple[str, ...] | list[str] = (),
    disposition: str = "append",
    source_name: str | None = None,
) -> LoadResult:
    fresh = pending_rows(source, warehouse, dataset, table, cursor, primary_key)
    return warehouse.load(
        fresh,
        dataset,
        table,
        disposition,
        primary_key=tuple(primary_key) or None,
        cursor_column=cursor,
        source=source_name,
    )
