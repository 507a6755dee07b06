"""Loading DataFrames into Parquet tables: append, replace, merge, insert-ignore and
incremental, with schema evolution and one audit record per load.

Layout below the warehouse root (a folder every executor can reach)::

    <root>/<dataset>/<table>/<version>/_load=<load>/[_bucket=<k>/]part-*.parquet
    <root>/_log/<dataset>/<table>/    the table's log (see ``tablelog``)

Every load writes a folder of its own.  Its log entry, with the files it added and removed, makes
it visible at once, after the data job has committed, and never in part.  A load that fails before
that leaves only an unlisted folder, so running it again gives the same rows.  An entry can
be created once: of two loads that built on the same state the later one fails and can be run
again.  ``replace`` writes a fresh version; the previous one stays readable, and so does the state
after every load until ``vacuum``.

Tables that keyed loads go into are bucketed by ``pmod(xxhash64(key), buckets)``, and inside a
bucket files are sorted by that hash and cut at ``file_rows``; the log holds each file's range.
A task sorts and writes one bucket, or of a larger one a slice: an equal range of hashes, of about
``TASK_BYTES`` and ``TASK_ROWS``.  So that their number is known, batches are staged as they come.
``merge``, ``insert_ignore`` and ``delete_insert`` read only the files whose range holds a hash of
the batch, and rewrite only those.  The number of buckets follows the table's bytes.
``compact`` puts small files together.

A table may be stored without the key columns that follow from its other ones (``row_keys``);
``read`` gives them.  Where a load or a catalog entry can't do without, they are written first.

Row counts come from ``Observation`` metrics of the write job itself -- no second
pass over the data; the files' ranges from their key columns alone.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import json
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidepool.operators.normalize import key_columns, with_keys
from tidepool.operators.tablelog import FOLD, LOG_FILES, SNAPSHOT_EVERY, DataFile, TableLog, TableState
from tidepool.session import delete_path, scratch_dir, session_conf

# Join on (key, bucket) over inputs hash-partitioned on the bucket alone: no second
# exchange, and every task holds whole buckets (one output file per bucket).
BUCKET_LOCAL_JOIN = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}

# append | replace | merge (upsert, last record wins) | insert_ignore (keep existing)
# | delete_insert (all rows of the batch's keys replace all rows of those keys)
DISPOSITIONS = ("append", "replace", "merge", "insert_ignore", "delete_insert")
KEYED = ("merge", "insert_ignore", "delete_insert")
BUCKET = "_bucket"
PART = "__part"
LOAD = "_load"
LEAST_BUCKETS = 8
BUCKET_BYTES = 512 << 20  # Parquet bytes of a bucket
TASK_BYTES = 16 << 20  # Parquet bytes, and rows, that one task of a keyed load sorts
TASK_ROWS = 1 << 19
TASK_FILES = 128  # files that it writes
DEAD_NAMES = 1000  # superseded files that a read of whole folders leaves out by name
CELLS = 4  # ranges of hashes a file, in which a merge looks for the batch's keys

FILE_ROWS = 1 << 20  # rows of a file of a bucketed table
FILE_BYTES = 128 << 20  # what ``compact`` aims at

AUDIT_SCHEMA = StructType(
    [
        StructField("load_id", StringType()),
        StructField("load_seq", LongType()),
        StructField("source", StringType()),
        StructField("dataset", StringType()),
        StructField("table_name", StringType()),
        StructField("disposition", StringType()),
        StructField("version_path", StringType()),
        StructField("rows_in", LongType()),
        StructField("rows_loaded", LongType()),
        StructField("table_schema", StringType()),
        StructField("primary_key", StringType()),
        StructField("buckets", IntegerType()),
        StructField("cursor_column", StringType()),
        StructField("cursor_max", StringType()),
        StructField("loaded_at", TimestampNTZType()),
        StructField("files_live", LongType()),
        StructField("files_read", LongType()),
        StructField("files_added", LongType()),
        StructField("files_removed", LongType()),
    ]
)


class LoadError(ValueError):
    """A load request that cannot be honoured (e.g. merge without a key)."""


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    dataset: str
    table: str
    disposition: str
    rows_in: int
    rows_loaded: int
    version_path: str


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def key_hash(primary_key: tuple[str, ...]) -> Column:
    return F.xxhash64(*[_q(k) for k in primary_key])


def bucket_of(primary_key: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(key_hash(primary_key), F.lit(buckets)).cast("int")


def slices_of(buckets: int, size: int, rows: int, file_rows: int = FILE_ROWS) -> int:
    """Slices of a bucket (a power of two), so that a task sorts ``TASK_BYTES`` and ``TASK_ROWS`` at most
    and cuts them into ``TASK_FILES`` files at most."""
    slices, most = 1, min(TASK_ROWS, TASK_FILES * file_rows)
    while slices * buckets * TASK_BYTES < size or slices * buckets * most < rows:
        slices *= 2
    return slices


def deal(df: DataFrame, primary_key: tuple[str, ...], buckets: int, slices: int) -> DataFrame:
    """A whole bucket in each task, or with ``slices`` an equal range of its hashes: task ``PART``.

    Neighbouring hashes meet in one task, so the ranges of a load's files do not overlap.
    """
    if slices == 1:
        return df.repartition(buckets, BUCKET)
    top = F.shiftrightunsigned(key_hash(primary_key), 65 - slices.bit_length()).cast("int")
    return df.withColumn(PART, F.col(BUCKET) * slices + top).repartitionById(buckets * slices, F.col(PART))


def load_folder(version: str, load_id: str) -> str:
    return f"{version}/{LOAD}=l-{load_id}"


def dedupe_last(
    df: DataFrame, primary_key: tuple[str, ...], order_by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: the greatest ``order_by`` wins (the whole row breaks ties).

    A max over a struct is a partially-aggregated group-by, so even a key holding a
    large share of the batch is reduced map-side before the shuffle.
    """
    cols = [c for c in df.columns if c not in primary_key]
    if not cols:
        return df.dropDuplicates(list(primary_key))
    order = [_q(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    best = F.max(F.struct(*order, F.struct(*[_q(c) for c in cols]).alias("row")))
    return (
        df.groupBy(*[_q(k) for k in primary_key])
        .agg(best.alias("_best"))
        .select(*[_q(k) for k in primary_key], *[F.col(f"_best.row.`{c}`").alias(c) for c in cols])
        .select(*[_q(c) for c in df.columns])
    )


def evolve(target: StructType | None, batch: DataFrame) -> tuple[StructType, DataFrame]:
    """Align ``batch`` with ``target``; returns (new table schema, aligned batch).

    New columns are added (older rows read NULL).  A column whose type differs from
    the table's is cast with ``try_cast``; values that do not come back equal when cast
    to their own type again (10.75 as a bigint, a time as a date) stay NULL there and are
    kept in a side column ``<col>__v_<type>`` of the batch type instead of losing digits.
    """
    if target is None:
        return batch.schema, batch
    fields = {f.name: f for f in target.fields}
    new_fields = list(target.fields)
    out: dict[str, Column] = {}
    for f in batch.schema.fields:
        if f.name == BUCKET:
            continue
        if f.name not in fields:
            new_fields.append(StructField(f.name, f.dataType, True))
            out[f.name] = _q(f.name)
            continue
        want = fields[f.name].dataType
        if want == f.dataType:
            out[f.name] = _q(f.name)
            continue
        casted = _q(f.name).try_cast(want)
        same = casted.try_cast(f.dataType).eqNullSafe(_q(f.name))
        out[f.name] = F.when(same, casted)
        side = f"{f.name}__v_{f.dataType.simpleString()}"
        if side not in fields and all(nf.name != side for nf in new_fields):
            new_fields.append(StructField(side, f.dataType, True))
        out[side] = F.when(~same, _q(f.name))
    schema = StructType(new_fields)
    carried = [F.col(BUCKET)] if BUCKET in batch.columns else []
    aligned = batch.select(
        *[
            (out[f.name] if f.name in out else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *carried,
    )
    return schema, aligned


class Warehouse:
    """Parquet tables under ``root`` with versioned replace and a log per table."""

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        buckets: int | None = None,
        catalog: bool = False,
        capture_plans: bool = False,
        bucket_bytes: int = BUCKET_BYTES,
        file_rows: int = FILE_ROWS,
        snapshot_every: int = SNAPSHOT_EVERY,
        fold: int = FOLD,
    ):
        """``buckets``: bucket count given to new keyed tables.  By default a keyed table
        starts without buckets, written as the batch comes, and the first keyed load into
        it deals its rows to as many as its bytes need.  ``bucket_bytes``: a keyed load
        doubles the buckets of a table until they hold so many bytes each at most.
        ``file_rows``: rows of a file of a bucketed table, what a keyed load rewrites.
        ``snapshot_every``, ``fold``: upkeep of the tables' logs (see ``tablelog``)."""
        self.spark = spark
        self.root = (root or scratch_dir(spark, "warehouse")).rstrip("/")
        self.buckets = buckets
        self.bucket_bytes = bucket_bytes
        self.file_rows = file_rows
        self.catalog = catalog  # keep `dataset.table` catalog entries current
        self.capture_plans = capture_plans  # keep formatted plans of write jobs
        self.plans: list[tuple[str, str]] = []
        self._upkeep = (snapshot_every, fold)
        self._logs: dict[tuple[str, str], TableLog] = {}

    def _capture(self, label: str, df: DataFrame) -> DataFrame:
        if self.capture_plans:
            buffer = io.StringIO()
            with contextlib.redirect_stdout(buffer):
                df.explain("formatted")
            self.plans.append((label, buffer.getvalue()))
        return df

    # -- the log ------------------------------------------------------------------

    @property
    def log_path(self) -> str:
        return f"{self.root}/_log"

    def _log(self, dataset: str, table: str) -> TableLog:
        key = (dataset, table)
        if key not in self._logs:
            self._logs[key] = TableLog(self.spark, self.root, dataset, table, *self._upkeep)
        return self._logs[key]

    def audit(self) -> DataFrame:
        """One row per load of every table, read from the logs by Spark."""
        tables = [f"{self.log_path}/{d}/{t}" for d, t in self._tables()]
        if not tables:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        rows = self.spark.read.schema(AUDIT_SCHEMA).option("pathGlobFilter", LOG_FILES).json(tables)
        # an entry can be there twice while it is being folded
        return rows.dropDuplicates(["dataset", "table_name", "load_seq"])

    def state(self, dataset: str, table: str, load_seq: int | None = None) -> TableState | None:
        """The table's state, now or after load ``load_seq``."""
        return self._log(dataset, table).state(load_seq)

    def has_batch(self, dataset: str, table: str, stream: str, batch: int) -> bool:
        """Whether that batch of a stream is loaded (idempotence of replayed micro-batches)."""
        st = self.state(dataset, table)
        return st is not None and st.batches.get(stream, -1) >= batch

    def read_files(self, st: TableState, files: list[DataFile] | None = None) -> DataFrame:
        """The rows of ``files`` (all live ones), with their bucket."""
        fields = list(st.schema.fields)
        if st.buckets:
            fields.append(StructField(BUCKET, IntegerType(), True))
        paths, dead = st.paths(files, DEAD_NAMES)
        if not paths:
            return self.spark.createDataFrame([], StructType(fields))
        schema = StructType([*fields, StructField(LOAD, StringType(), True)])
        rows = self.spark.read.schema(schema).option("basePath", st.version_path).parquet(*paths)
        if dead:  # a filter on files: Spark applies it to what it has listed
            names = F.substring_index("_metadata.file_path", "/", -1 - dead[0].count("/"))
            rows = rows.where(~names.isin(dead))
        return rows.drop(LOAD)

    def read(self, dataset: str, table: str, load_seq: int | None = None) -> DataFrame:
        """The table's rows, now or as they were after load ``load_seq`` (until ``vacuum``)."""
        st = self.state(dataset, table, load_seq)
        if st is None:
            after = "" if load_seq is None else f" after load {load_seq}"
            raise LoadError(f"Table does not exist: {dataset}.{table}{after}")
        if load_seq is not None and load_seq < self.state(dataset, table).oldest:
            raise LoadError(f"{dataset}.{table} after load {load_seq} is vacuumed")
        return self._rows(st)

    def _rows(self, st: TableState) -> DataFrame:
        df = self.read_files(st).drop(BUCKET) if st.buckets else self.read_files(st)
        return with_keys(df, st.row_keys) if st.row_keys else df

    def _tables(self) -> list[tuple[str, str]]:
        """(dataset, table) of every table (bounded by table count)."""
        out = []
        fs, jpath = self._fs(self.log_path)
        if not fs.exists(jpath):
            return out
        for dataset in fs.listStatus(jpath):
            for table in fs.listStatus(dataset.getPath()):
                out.append((dataset.getPath().getName(), table.getPath().getName()))
        return sorted(out)

    # -- catalog ------------------------------------------------------------------

    def register_views(self) -> list[str]:
        """Temp views ``<dataset>___<table>`` over every table's current version."""
        names = []
        for dataset, table in self._tables():
            name = f"{dataset}___{table}"
            self.read(dataset, table).createOrReplaceTempView(name)
            names.append(name)
        return names

    def register_table(self, dataset: str, table: str) -> str:
        """Point the catalog table ``dataset.table`` at the current version.

        The entry is external (``LOCATION``): dropping and re-creating it is a
        metadata operation.  Its partitions are folders, so a folder in which only some files
        are live is compacted first.
        """
        st = self.state(dataset, table)
        if st is None:
            raise LoadError(f"Table does not exist: {dataset}.{table}")
        if st.row_keys:
            st = self._store_keys(st)
        if partial := set(st.partial_folders()):
            self._compact(st, [f for f in st.files.values() if f.folder in partial], FILE_BYTES)
            st = self.state(dataset, table)
        name = f"`{dataset}`.`{table}`"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.schema.fields)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        location = st.version_path.replace("'", "\\'")
        parts = [f"`{LOAD}` string", *([f"`{BUCKET}` int"] if st.buckets else [])]
        names = ", ".join(p.split()[0] for p in parts)
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join([cols, *parts])}) USING parquet "
            f"PARTITIONED BY ({names}) LOCATION '{location}'"
        )
        listed = [
            f"PARTITION (`{LOAD}`='l-{load_id}'" + (")" if b is None else f", `{BUCKET}`={b})")
            for load_id, buckets in st.live.items()
            for b in ([None] if buckets is None else buckets)
        ]
        if listed:  # live folders only
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(listed)}")
        return f"{dataset}.{table}"

    def register_catalog(self) -> list[str]:
        """Re-create every table's catalog entry (e.g. in a new session)."""
        return [self.register_table(d, t) for d, t in self._tables()]

    def _fs(self, path: str):
        jvm = self.spark._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def vacuum(self, dataset: str, table: str, keep: int = 2) -> list[str]:
        """Delete versions of a table older than its ``keep`` most recent ones, and files
        that none of its ``keep`` most recent loads reads.

        Only files that the log names are touched (metadata operations on the driver), so a
        running load is safe.  The log notes what is gone before it goes.
        """
        log = self._log(dataset, table)
        st = log.state()
        gone = st.expired(keep) if st is not None else []
        if not gone:
            return []
        self._record(st, disposition="vacuum", keep=keep, rows_in=0, rows_loaded=0)
        for path in gone:
            fs, jpath = self._fs(path)
            fs.delete(jpath, True)
        return gone

    def compact_audit(self) -> int:
        """Put the single entries of every log into one file a table; returns how many there were."""
        return sum(self._log(d, t).fold() for d, t in self._tables())

    # -- compaction ---------------------------------------------------------------

    def compact(self, dataset: str, table: str, file_bytes: int = FILE_BYTES) -> LoadResult | None:
        """Put small live files (under half of ``file_bytes``) together, as one load.

        Without buckets Spark packs the files into read partitions of ``file_bytes`` and each
        becomes one file, so nothing is shuffled; with buckets the small files of a bucket meet in
        its task, sorted by their keys' hash.  Rows and schema stay; earlier states stay readable
        until ``vacuum``.  A load that commits meanwhile makes it fail without effect.
        """
        st = self.state(dataset, table)
        if st is None:
            raise LoadError(f"Table does not exist: {dataset}.{table}")
        small = [f for f in st.files.values() if 2 * f.bytes < file_bytes]
        if st.buckets:  # a bucket's only small file has nothing to join
            count: dict[int, int] = {}
            for f in small:
                count[f.bucket] = count.get(f.bucket, 0) + 1
            small = [f for f in small if count[f.bucket] > 1]
        return self._compact(st, small, file_bytes) if len(small) > 1 else None

    def _compact(self, st: TableState, files: list[DataFile], file_bytes: int) -> LoadResult:
        load_id = uuid.uuid4().hex[:16]
        folder = load_folder(st.version_path, load_id)
        _, rows = evolve(st.schema, self.read_files(st, files))
        obs = Observation(f"compact_{load_id}")
        if st.buckets:
            slices = slices_of(st.buckets, sum(f.bytes for f in files), sum(f.rows for f in files), self.file_rows)
            rows = deal(rows, st.primary_key, st.buckets, slices)
            n = self._write("compact buckets", rows, folder, st.buckets, obs, st.primary_key)
        else:
            # the open cost is what Spark adds to each file's size when it packs them
            packing = {"spark__sql__files__maxPartitionBytes": str(file_bytes),
                       "spark__sql__files__openCostInBytes": "0",
                       "spark__sql__files__minPartitionNum": "1"}
            with session_conf(self.spark, **packing):
                n = self._write("compact", rows, folder, None, obs)
        if n != sum(f.rows for f in files):
            raise LoadError(f"{st.dataset}.{st.table}: {n} rows compacted of {sum(f.rows for f in files)}")
        added = self._written(st.version_path, folder, st.schema, st.primary_key, st.buckets)
        self._record(
            st, load_id=load_id, disposition="compact", rows_in=n, rows_loaded=n,
            files_read=len(files), removed=[f.path for f in files], added=added,
        )
        return LoadResult(load_id, st.dataset, st.table, "compact", n, n, st.version_path)

    def _store_keys(self, st: TableState) -> TableState:
        """Rewrite a table with the key columns that reads have derived, as a load of its own."""
        load_id = uuid.uuid4().hex[:16]
        pk, rows = key_columns(st.row_keys), self._rows(st)
        version = self._new_version(st.dataset, st.table, load_id)
        folder = load_folder(version, load_id)
        obs = Observation(f"keys_{load_id}")
        if st.buckets:
            dealt = rows.withColumn(BUCKET, bucket_of(pk, st.buckets))
            n = self._write_buckets("store keys", dealt, folder, st.buckets, obs, pk)
        else:
            n = self._write("store keys", rows, folder, None, obs)
        self._record(
            st, load_id=load_id, disposition="replace", version_path=version, rows_in=n, rows_loaded=n,
            table_schema=rows.schema.json(), primary_key=",".join(pk), row_keys=None, reset=True,
            files_read=len(st.files), added=self._written(version, folder, rows.schema, pk, st.buckets),
        )
        return self.state(st.dataset, st.table)

    # -- writes -------------------------------------------------------------------

    def _bucket_count(self, st: TableState, given: int | None) -> int:
        """Buckets of a table after a keyed load: those it has, doubled until its live
        bytes fit (each doubling rewrites the table, so a row moves a few times at most)."""
        size = st.bytes
        count = st.buckets or given or self.buckets or LEAST_BUCKETS
        while count * self.bucket_bytes < size:
            count *= 2
        return count

    def _new_version(self, dataset: str, table: str, load_id: str) -> str:
        return f"{self.root}/{dataset}/{table}/v-{load_id}"

    def _write(
        self, label: str, df: DataFrame, path: str, buckets: int | None, obs: Observation,
        primary_key: tuple[str, ...] = (),
    ) -> int:
        """Write a load's folder, a bucket's files sorted by their keys' hash; returns its rows."""
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if buckets:  # above the count: an empty stage below a sort is dropped, with its metrics
            df = df.drop(PART).sortWithinPartitions(BUCKET, key_hash(primary_key))
        writer = self._capture(label, df).write.mode("errorifexists")
        if buckets:
            # tasks move their own files, instead of the driver all of them; nothing reads the folder before its entry
            writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            writer = writer.partitionBy(BUCKET).option("maxRecordsPerFile", self.file_rows)
        writer.parquet(path)
        return int(obs.get["rows"])

    def _stage(self, label: str, df: DataFrame, path: str) -> tuple[DataFrame, int, int, list[int]]:
        """Write a bucketed batch as it comes, without a shuffle: the rows as read again, their
        number and bytes, and the buckets they are in (at most as many ints)."""
        obs = Observation(f"batch_{uuid.uuid4().hex[:8]}")
        rows = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(BUCKET).alias("touched"))
        self._capture(label, rows).write.parquet(path)
        fs, jpath = self._fs(path)
        told = obs.get
        staged = self.spark.read.schema(df.schema).parquet(path)
        return staged, int(told["rows"]), fs.getContentSummary(jpath).getLength(), sorted(told["touched"] or [])

    def _write_buckets(self, label, df, path, buckets, obs, primary_key) -> int:
        """Write a batch into a folder of its own by buckets; its size is known once it is staged."""
        staging = scratch_dir(self.spark, "bucket-batch")
        try:
            staged, rows, size, _ = self._stage(f"stage {label}", df, staging)
            dealt = deal(staged, primary_key, buckets, slices_of(buckets, size, rows, self.file_rows))
            return self._write(label, dealt, path, buckets, obs, primary_key)
        finally:
            delete_path(self.spark, staging)

    def _written(
        self, version: str, folder: str, schema: StructType, primary_key: tuple[str, ...], buckets: int | None
    ) -> list[DataFile]:
        """The files of a load's folder that have rows; reads their footers, and in a bucketed
        table their key columns."""
        fields = [*schema.fields, StructField(BUCKET, IntegerType())] if buckets else list(schema.fields)
        rows = self.spark.read.schema(StructType(fields)).parquet(folder)
        keys = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")]
        aggs = [F.count("*").alias("rows")]
        if buckets:
            keys.append(F.col(BUCKET))
            h = key_hash(primary_key)
            aggs += [F.min(h).alias("low"), F.max(h).alias("high")]
        out = []
        start = folder.rpartition("/")[2]  # _load=l-<id>, the same in a path of any form
        for r in rows.groupBy(*keys).agg(*aggs).collect():  # one row per file
            path = start + r["path"].partition(start)[2]
            out.append(DataFile(path, r["bytes"], r["rows"], *((r[BUCKET], r["low"], r["high"]) if buckets else ())))
        return sorted(out)

    def _record(self, st: TableState | None, **fields) -> None:
        """Append the log entry that follows the state ``st``; a second load that builds on
        the same state fails.  It is metadata, so no Spark job is spent on it."""
        entry = {name: None for name in AUDIT_SCHEMA.fieldNames()} | {"reset": False, "added": [], "removed": []}
        if st is not None:
            entry |= {
                "dataset": st.dataset,
                "table_name": st.table,
                "version_path": st.version_path,
                "table_schema": st.schema.json(),
                "primary_key": ",".join(st.primary_key) or None,
                "buckets": st.buckets,
                "cursor_column": st.cursor_column,
                "cursor_max": st.cursor_max,
                "row_keys": st.row_keys,
            }
        entry |= fields
        kept = 0 if st is None or entry["reset"] else len(st.files) - len(entry["removed"])
        entry["files_live"] = kept + len(entry["added"])
        entry["files_added"] = len(entry["added"])
        entry["files_removed"] = (len(st.files) if st and entry["reset"] else 0) + len(entry["removed"])
        entry["loaded_at"] = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
        if not self._log(entry["dataset"], entry["table_name"]).commit(st, entry):
            where = f"{entry['dataset']}.{entry['table_name']}"
            raise LoadError(f"{where} changed while load {entry['load_id']} ran; run it again")

    def load(
        self,
        df: DataFrame,
        dataset: str,
        table: str,
        disposition: str = "append",
        primary_key: tuple[str, ...] | list[str] | None = None,
        order_by: tuple[str, ...] | list[str] = (),
        cursor_column: str | None = None,
        source: str | None = None,
        buckets: int | None = None,
        dedupe: bool = True,
        delete_keys: DataFrame | None = None,
        batch: tuple[str, int] | None = None,
        row_keys: dict | None = None,
    ) -> LoadResult:
        """Load ``df`` into ``dataset.table``.

        ``buckets`` applies when a keyed table is created, replaced or first dealt to
        buckets; later keyed loads keep or double the table's bucket count.  ``rows_in`` is observed before
        de-duplication (a map-stage retry after an executor loss may over-count it);
        ``rows_loaded`` is observed in the writing stage and is exact.  ``dedupe``
        (merge / insert_ignore) keeps one row per key; child tables keyed by their
        parent turn it off so that all elements of a parent move together.
        ``delete_keys`` (delete_insert) are keys whose stored rows go although the batch
        has no rows for them.  ``batch`` is (stream, batch number) of a load from a stream.
        ``row_keys``: ``df`` holds the columns that its keys derive from (``normalize.with_keys``)
        instead of the keys; the table has to be new or stored in the same way.
        """
        if disposition not in DISPOSITIONS:
            raise LoadError(f"write_disposition must be one of {', '.join(DISPOSITIONS)}")
        if not df.columns:  # no record, so no schema: an empty result changes no column
            known = self.state(dataset, table)
            if known is None or disposition != "replace":
                path = known.version_path if known is not None else ""
                return LoadResult("", dataset, table, disposition, 0, 0, path)
            df = self.spark.createDataFrame([], self._rows(known).schema)
        pk = tuple(primary_key or ())
        st = self.state(dataset, table)
        stored_key = () if st is None else st.primary_key
        if st is not None and st.row_keys != row_keys:
            if st.row_keys:
                stored_key = key_columns(st.row_keys)
            if disposition != "replace":
                if row_keys:
                    raise LoadError(f"{dataset}.{table} is not stored by {', '.join(row_keys['root'])}")
                st = self._store_keys(st)
        if st is not None and stored_key and (not pk or disposition == "append"):
            pk = stored_key  # an append does not deal the table anew
        if disposition in KEYED and not pk:
            raise LoadError(f"{disposition} into {dataset}.{table} needs a primary_key")

        load_id = uuid.uuid4().hex[:16]
        batch_obs = Observation(f"in_{load_id}")
        cursor_aggs = [F.max(_q(cursor_column)).cast("string").alias("cursor_max")] if cursor_column else []
        incoming = df.observe(batch_obs, F.count(F.lit(1)).alias("rows_in"), *cursor_aggs)

        if not pk:
            buckets = None
        elif st is not None and disposition in KEYED:
            buckets = self._bucket_count(st, buckets)
        elif st is not None and disposition == "append":
            buckets = st.buckets
        else:  # sized by its bytes when the first keyed load reads it
            buckets = buckets or self.buckets
        target_schema = None if (st is None or disposition == "replace") else st.schema
        schema, aligned = evolve(target_schema, incoming)
        if disposition in ("merge", "insert_ignore") and dedupe:
            aligned = dedupe_last(aligned, pk, tuple(order_by))
        if disposition in KEYED:  # a row without key could neither match nor be replaced
            missing = F.lit(False)
            for k in pk:
                missing = missing | _q(k).isNull()
            problem = F.raise_error(F.lit(f"NULL key ({', '.join(pk)}) in a load into {dataset}.{table}"))
            aligned = aligned.where(F.when(missing, problem.cast("boolean")).otherwise(F.lit(True)))
        if buckets:
            aligned = aligned.withColumn(BUCKET, bucket_of(pk, buckets))

        out_obs = Observation(f"out_{load_id}")
        version = self._new_version(dataset, table, load_id)
        if st is not None and disposition != "replace":
            version = st.version_path
        folder = load_folder(version, load_id)
        reset = st is not None and disposition == "replace"
        read: list[DataFile] = []
        replaced: list[DataFile] = []
        if st is None or disposition in ("replace", "append"):
            if buckets:
                rows = self._write_buckets(f"write {folder}", aligned, folder, buckets, out_obs, pk)
            else:
                rows = self._write(f"write {folder}", aligned, folder, None, out_obs)
            wrote = True
        else:
            gone = None
            if disposition == "delete_insert" and delete_keys is not None:
                gone = delete_keys.select(*[_q(k).cast(schema[k].dataType).alias(k) for k in pk])
                gone = gone.withColumn(BUCKET, bucket_of(pk, buckets))
            reset = st.buckets != buckets or st.primary_key != pk
            rows, wrote, read = self._merge(
                st, schema, aligned, disposition, folder, out_obs, pk, buckets, gone
            )
            replaced = [] if reset or disposition == "insert_ignore" else read

        metrics = batch_obs.get
        cursor_max = metrics.get("cursor_max") if cursor_column else None
        if cursor_column and cursor_max is None and st is not None:
            cursor_max = st.cursor_max
        self._record(
            st,
            load_id=load_id,
            source=source,
            dataset=dataset,
            table_name=table,
            disposition=disposition,
            version_path=version,
            rows_in=int(metrics.get("rows_in", 0)),
            rows_loaded=int(rows),
            table_schema=schema.json(),
            primary_key=",".join(pk) if pk else None,
            buckets=buckets,
            cursor_column=cursor_column,
            cursor_max=cursor_max,
            files_read=len(read),
            row_keys=row_keys,
            reset=reset,
            removed=[f.path for f in replaced],
            added=self._written(version, folder, schema, pk, buckets) if wrote else [],
            **({"stream": batch[0], "batch": batch[1]} if batch else {}),
        )
        if self.catalog:
            self.register_table(dataset, table)
        return LoadResult(load_id, dataset, table, disposition, int(metrics.get("rows_in", 0)), int(rows), version)

    def _merge(
        self, st, schema, batch, disposition, folder, obs, pk, buckets, gone=None
    ) -> tuple[int, bool, list[DataFile]]:
        """Write the new rows of the files the batch touches; returns the rows of the batch
        that were loaded, whether a folder was written, and the table's files that were read.

        1. The deduplicated batch is staged as it comes.  The same job observes its row
           count and the set of buckets it touches (at most ``buckets`` small ints).
           Staging also cuts the lineage to the source.
        2. The table's files whose range of hashes holds one of the batch are read and
           joined with the staged batch; both sides are dealt to buckets, or to slices
           of buckets where the rows are many, so the join on ``(key, bucket)`` needs no
           further exchange.  If the number of buckets or the key changes, all rows of the
           table are read and move into their new buckets.
        3. The result goes to the load's own folder.  The files being read are never
           replaced, so retried tasks and concurrent readers see intact input.
        """
        staging = [scratch_dir(self.spark, "merge-batch"), scratch_dir(self.spark, "merge-keys")]
        try:
            return self._merge_staged(st, schema, batch, disposition, folder, obs, pk, buckets, gone, staging)
        finally:
            for path in staging:
                delete_path(self.spark, path)

    def _touched_files(self, st: TableState, keys: list[DataFrame], touched: list[int]) -> list[DataFile]:
        """Live files of the touched buckets whose range of hashes holds that of a key.

        Buckets with one file need no look.  Else the hashes of the staged keys are reduced to the
        least and greatest of each of a few cells a file, and files whose range meets none of these
        are left out.  What is collected is metadata like the files' ranges: at most one row a key,
        and twice ``CELLS`` a file where buckets have equally many.
        """
        among = set(touched)
        files = [f for f in st.files.values() if f.bucket in among]
        count: dict[int, int] = {}
        for f in files:
            count[f.bucket] = count.get(f.bucket, 0) + 1
        if len(files) <= len(count):
            return files
        bits = (CELLS * max(count.values())).bit_length()
        cells = None
        for part in keys:
            part = part.select(BUCKET, key_hash(st.primary_key).alias("h"))
            cells = part if cells is None else cells.union(part)
        cells = cells.groupBy(BUCKET, F.shiftright("h", 64 - bits)).agg(F.min("h").alias("low"), F.max("h").alias("high"))
        found = cells.select(BUCKET, "low", "high").orderBy(BUCKET, "low").toArrow()
        bucket, low, high = (found.column(c).to_numpy() for c in (BUCKET, "low", "high"))
        of = {b: slice(*np.searchsorted(bucket, [b, b + 1])) for b in count}
        out = []
        for f in files:
            at = int(np.searchsorted(high[of[f.bucket]], f.low))  # the first cell that ends at or after it
            if count[f.bucket] == 1 or (at < len(low[of[f.bucket]]) and low[of[f.bucket]][at] <= f.high):
                out.append(f)
        return out

    def _merge_staged(self, st, schema, batch, disposition, folder, obs, pk, buckets, gone, staging):
        moved = st.buckets != buckets or st.primary_key != pk
        staged, batch_rows, size, touched = self._stage("stage merge batch", batch, staging[0])
        keys = [staged]
        if gone is not None:
            gone.write.parquet(staging[1])
            gone = self.spark.read.schema(gone.schema).parquet(staging[1])
            extra = gone.agg(F.collect_set(BUCKET).alias("b")).first()["b"]  # at most ``buckets`` ints
            touched = sorted({*touched, *extra})
            keys.append(gone)
        if not touched and not moved:
            return 0, False, []
        if moved:
            files = list(st.files.values())
            current = self.read_files(st).withColumn(BUCKET, bucket_of(pk, buckets))
        else:
            files = self._touched_files(st, keys, touched)
            current = self.read_files(st, files).where(F.col(BUCKET).isin(touched))
        _, target = evolve(schema, current)
        size, rows = size + sum(f.bytes for f in files), batch_rows + sum(f.rows for f in files)
        slices = slices_of(buckets, size, rows, self.file_rows)
        staged, target = (deal(df, pk, buckets, slices) for df in (staged, target))
        on = [*pk, BUCKET, *([PART] if slices > 1 else [])]
        if disposition == "insert_ignore":
            fresh = staged.join(target.select(*on), on, "left_anti").select(*staged.columns)
            if moved:
                fresh_obs = Observation(f"fresh_{uuid.uuid4().hex[:8]}")
                fresh = fresh.observe(fresh_obs, F.count(F.lit(1)).alias("rows"))
                fresh = target.unionByName(fresh)
            with session_conf(self.spark, **BUCKET_LOCAL_JOIN):
                rows = self._write("insert buckets", fresh, folder, buckets, obs, pk)
            return int(fresh_obs.get["rows"]) if moved else rows, True, files
        if disposition == "delete_insert":
            # keys that come twice do no harm to an anti join
            kept = target.join(staged.select(*on), on, "left_anti").select(*target.columns)
            if gone is not None:
                kept = kept.join(deal(gone, pk, buckets, slices).select(*on), on, "left_anti").select(*target.columns)
            with session_conf(self.spark, **BUCKET_LOCAL_JOIN):
                self._write("delete-insert buckets", kept.unionByName(staged), folder, buckets, obs, pk)
            return batch_rows, True, files
        values = [c for c in schema.fieldNames() if c not in pk]
        incoming = staged.select(
            *[_q(c) for c in on],
            *[_q(c).alias(f"__new_{c}") for c in values],
            F.lit(True).alias("__new"),
        )
        merged = target.join(incoming, on, "full_outer").select(
            *[_q(c) for c in pk],
            *[
                F.when(F.col("__new").isNotNull(), F.col(f"`__new_{c}`")).otherwise(_q(c)).alias(c)
                for c in values
            ],
            F.col(BUCKET),
        )
        with session_conf(self.spark, **BUCKET_LOCAL_JOIN):
            self._write("merge buckets", merged, folder, buckets, obs, pk)
        return batch_rows, True, files
