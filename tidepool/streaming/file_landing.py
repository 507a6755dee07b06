"""Load new files from a landing folder exactly once.

A Structured Streaming file source with ``trigger(availableNow=True)`` processes
every file not yet recorded in its checkpoint and stops; each micro-batch is loaded
into the warehouse from ``foreachBatch``.  A rerun with no new files loads nothing;
a new file loads only itself.  The checkpoint sits in the shared folder, so a
restarted driver or a lost executor resumes without re-loading files; a micro-batch
replayed because the driver died between the load and the checkpoint commit is
recognised by its (checkpoint, batch id) in the table's log and skipped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidepool.operators.load import LoadResult, Warehouse
from tidepool.sources.files import decoded_file_path, normalize_timestamps, select_files


@dataclass
class LandingRun:
    loads: list[LoadResult] = field(default_factory=list)

    @property
    def rows_loaded(self) -> int:
        return sum(r.rows_loaded for r in self.loads)


def ingest_new_files(
    spark: SparkSession,
    pattern: str,
    fmt: str,
    schema: StructType | str,
    warehouse: Warehouse,
    dataset: str,
    table: str,
    checkpoint: str,
    disposition: str = "append",
    primary_key: tuple[str, ...] | list[str] | None = None,
    max_files_per_trigger: int | None = None,
) -> LandingRun:
    """Run once over the files that arrived since the last run (streaming needs a
    schema up front: file sources do not infer one)."""
    sel = select_files(pattern)
    reader = spark.readStream.schema(schema).options(**sel.options)
    if fmt in ("csv", "csv.gz"):
        reader = reader.option("header", "true").option("enforceSchema", "false")
        reader = reader.option("quote", '"').option("escape", '"')
    if fmt != "parquet":
        reader = reader.option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.format({"jsonl": "json", "csv.gz": "csv"}.get(fmt, fmt)).load(sel.path)
    if sel.path_regex is not None:
        stream = stream.where(decoded_file_path().rlike(sel.path_regex))
    run = LandingRun()

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # a batch replayed after a driver failure (loaded, checkpoint not yet
        # committed) is recognised and not loaded twice
        if warehouse.has_batch(dataset, table, checkpoint, batch_id):
            return
        run.loads.append(
            warehouse.load(
                normalize_timestamps(batch),
                dataset,
                table,
                disposition,
                primary_key=primary_key,
                source=f"landing:{checkpoint}:{batch_id}",
                batch=(checkpoint, batch_id),
            )
        )

    query = (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return run
