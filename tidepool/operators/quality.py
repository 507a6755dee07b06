"""Data tests: ``not_null`` and ``unique``, plus the ordered build that stops on a
failing test before any dependent model is built.

Each test returns a small DataFrame ``(test, table_name, column_name, failures)``:
``failures`` counts offending rows (not_null) or duplicated keys (unique).  All
``not_null`` checks of one table run in a single aggregation pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.load import BUCKET, Warehouse
from tidepool.operators.tablelog import DataFile, TableState

RESULT_COLUMNS = ("test", "table_name", "column_name", "failures")


class DataTestFailure(RuntimeError):
    """A data test failed; dependents of the tested model were not built."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        desc = ", ".join(
            f"{f['test']}({f['table_name']}.{f['column_name']})={f['failures']}"
            for f in failures
        )
        super().__init__(f"Data tests failed: {desc}")


def not_null(df: DataFrame, table_name: str, columns: Iterable[str]) -> DataFrame:
    columns = list(columns)
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit("not_null").alias("test"),
            F.lit(table_name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"c{i}").cast("bigint").alias("failures"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """Keys that occur more than once (NULLs ignored), counted.

    A group-by rather than a window: partial aggregation keeps a hot key to one row
    per map task before the shuffle.
    """
    dupes = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    return dupes.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit("unique").alias("test"),
        F.lit(table_name).alias("table_name"),
        F.lit(column).alias("column_name"),
        "failures",
    )


# Bucket groups of one job: what bounds its plan.
GROUPS = 64
BUCKET_FAILURES = "bucket int, layout string, files string, failures bigint"


def _digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def _bucket_groups(by_bucket: dict[int, list[DataFile]], most_bytes: int, tasks: int) -> list[list[DataFile]]:
    """The files of whole buckets in groups of at most ``most_bytes`` (a larger bucket is a group
    of its own), and in as many groups as there are tasks where they are small."""
    size = {b: sum(f.bytes for f in files) for b, files in by_bucket.items()}
    limit = min(most_bytes, -(-sum(size.values()) // max(tasks, 1)))
    groups: list[list[DataFile]] = []
    room = 0
    for b, files in sorted(by_bucket.items()):
        if not groups or size[b] > room:
            groups.append([])
            room = limit
        groups[-1] += files
        room -= size[b]
    return groups


def duplicates_by_bucket(warehouse: Warehouse, st: TableState, groups: list[list[DataFile]]) -> DataFrame:
    """(bucket, failures): duplicated keys of every bucket, without an exchange.

    Equal keys share a bucket, so a task that reads whole buckets can count them alone: each group
    (the files of whole buckets) is one partition, which the grouping by key is already clustered
    on.  Only the key columns are read.
    """
    keys = [F.col(f"`{k}`") for k in st.primary_key]
    present = F.lit(True)
    for k in keys:
        present = present & k.isNotNull()
    parts = []
    for files in groups:
        rows = warehouse.read_files(st, files).where(present).select(F.col(BUCKET).alias("__bucket"), *keys)
        counted = rows.coalesce(1).groupBy("__bucket", *keys).agg(F.count(F.lit(1)).alias("__n"))
        failures = F.count_if(F.col("__n") > 1).cast("bigint").alias("failures")
        parts.append(counted.groupBy(F.col("__bucket").alias("bucket")).agg(failures))
    return union_results(parts)


def unique_in_buckets(warehouse: Warehouse, dataset: str, table: str) -> DataFrame:
    """``unique`` of a bucketed table's key (all its columns together), bucket by bucket.

    The failures of every bucket are kept as the table ``<table>__unique`` of the same dataset, with a
    digest of the files they were counted in.  A later run counts only buckets whose files have
    changed since; a new bucket count, key or version changes all of them.  The table is read in
    jobs of ``GROUPS`` bucket groups; what is collected has one row per bucket.  Keys with a NULL
    are ignored.  A table without buckets takes the shuffled way, with the same result.
    """
    st = warehouse.state(dataset, table)
    if st is None or not st.primary_key:
        raise ValueError(f"{dataset}.{table} has no key to test")
    spark = warehouse.spark
    name = ",".join(st.primary_key)
    if not st.buckets:
        keys = [F.col(f"`{k}`") for k in st.primary_key]
        nulls = F.lit(False)
        for k in keys:
            nulls = nulls | k.isNull()
        rows = warehouse.read(dataset, table).select(F.when(~nulls, F.struct(*keys)).alias("key"))
        return unique(rows, table, "key").withColumns(
            {"column_name": F.lit(name), "buckets_read": F.lit(None).cast("bigint")}
        )
    by_bucket: dict[int, list[DataFile]] = {}
    for f in st.files.values():
        by_bucket.setdefault(f.bucket, []).append(f)
    layout = _digest([st.version_path, str(st.buckets), *st.primary_key])
    files = {b: _digest(sorted(f.path for f in own)) for b, own in by_bucket.items()}
    record = f"{table}__unique"
    known = {}
    if warehouse.state(dataset, record) is not None:
        for r in warehouse.read(dataset, record).collect():  # one row per bucket
            if r["layout"] == layout and files.get(r["bucket"]) == r["files"]:
                known[r["bucket"]] = r["failures"]
    changed = {b: own for b, own in by_bucket.items() if b not in known}
    found = known | dict.fromkeys(changed, 0)  # a bucket of NULL keys alone has no row below
    groups = _bucket_groups(changed, warehouse.bucket_bytes, spark.sparkContext.defaultParallelism)
    for at in range(0, len(groups), GROUPS):
        rows = duplicates_by_bucket(warehouse, st, groups[at : at + GROUPS])
        found |= {r["bucket"]: r["failures"] for r in rows.collect()}  # one row per bucket
    if changed:
        rows = [(b, layout, files[b], n) for b, n in sorted(found.items())]
        warehouse.load(spark.createDataFrame(rows, BUCKET_FAILURES), dataset, record, "replace")
    result = [("unique", table, name, sum(found.values()), len(changed))]
    return spark.createDataFrame(
        result, "test string, table_name string, column_name string, failures bigint, buckets_read bigint"
    )


def union_results(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class ModelTests:
    table_name: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    def results(self, df: DataFrame) -> DataFrame:
        parts = []
        if self.not_null:
            parts.append(not_null(df, self.table_name, self.not_null))
        parts += [unique(df, self.table_name, c) for c in self.unique]
        return union_results(parts)


@dataclass
class BuildStep:
    """A model (or source) and the tests that must pass before dependents build."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    tests: ModelTests | None = None
    stored: bool = False  # written before it is tested


@dataclass
class BuildReport:
    models: dict[str, DataFrame] = field(default_factory=dict)
    results: list[dict] = field(default_factory=list)


def run_build(
    steps: list[BuildStep],
    fail_fast: bool = True,
    store: Callable[[str, DataFrame], DataFrame] | None = None,
    view: Callable[[str, DataFrame], None] | None = None,
) -> BuildReport:
    """Build steps in order; after each, run its tests and stop if any fails.

    ``store`` writes a stored model and returns it as read back, so its tests and everything
    that depends on it see the written rows; ``view`` registers the others.

    Test results are tiny (one row per test) so collecting them is bounded.
    """
    report = BuildReport()
    for step in steps:
        df = step.build(report.models)
        if step.stored and store is not None:
            df = store(step.name, df)
        elif view is not None:
            view(step.name, df)
        report.models[step.name] = df
        if step.tests is None:
            continue
        rows = [r.asDict() for r in step.tests.results(df).collect()]
        for r in rows:
            r["passed"] = r["failures"] == 0
        report.results.extend(rows)
        failed = [r for r in rows if not r["passed"]]
        if failed and fail_fast:
            raise DataTestFailure(failed)
    return report


# The tests declared on the raw sources and on the mart.
SOURCE_TESTS = {
    "customers": ModelTests("customers", not_null=("customer_id",)),
    "events": ModelTests("events", not_null=("event_id",)),
    "orders": ModelTests("orders", not_null=("order_id",)),
}
MART_TESTS = ModelTests(
    "customer_activity", not_null=("customer_id", "lifetime_value"), unique=("customer_id",)
)


def suite_results(raw: dict[str, DataFrame], mart: DataFrame) -> DataFrame:
    """All source and mart tests as one result DataFrame (no early stop)."""
    parts = [SOURCE_TESTS[name].results(raw[name]) for name in ("customers", "events", "orders")]
    parts.append(MART_TESTS.results(mart))
    out = union_results(parts)
    return out.withColumn("passed", F.col("failures") == 0)
