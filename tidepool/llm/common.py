"""Helpers shared by the corpus operators: materialised tables, components, ranks, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import delete_path, scratch_dir

#: Words are maximal runs of anything but space and the controls 9 to 13 (fixed by the contracts).
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The lineage ends at files that every executor can read again, so a lost executor
    costs only the tasks that ran on it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name clashes with an operator's own."""
    return F.struct(*(column(c) for c in docs.columns)).alias("doc")


def row_and_text(docs: DataFrame) -> list[Column]:
    """``whole_row``, and its text beside it only where that is not a string yet (see ``text_of``)."""
    known = dict(docs.dtypes).get("text") == "string"
    return [whole_row(docs)] + ([] if known else [F.col("text").cast("string").alias("text")])


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: a column, or the field of its whole rows."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("doc").field("text")


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` wrote and that nothing reads any more."""
    for table in tables:
        path = getattr(table, "scratch_path", None)
        if path:
            delete_path(table.sparkSession, path)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's text, mod 4, is 2 (a null id counts as not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- connected components -----------------------------------------------------------------


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(v, component): the smallest vertex reachable from each vertex of ``edges(u, v)``.

    Alternating large-star and small-star steps.  Each step is a partially aggregated
    minimum per vertex and an equi-join, so a hub of any degree is reduced map-side and
    its rows can be split by the skew join.  Loops and null ends are ignored.
    """
    pairs = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    pairs = materialize(pairs.distinct(), purpose)
    state = None
    while True:
        seen = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("h")
        ).first()
        if not seen["n"] or (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v")))
        before, pairs = pairs, materialize(small.where("u <> v").distinct(), purpose)
        discard(before)
    roots = pairs.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias("component"))
    return (
        pairs.select("u", F.col("v").alias("component"))
        .union(roots)
        .groupBy(F.col("u").alias("v"))
        .agg(F.min("component").alias("component"))
    )


# -- global ranks -------------------------------------------------------------------------


def with_global_rank(df: DataFrame, order: list, purpose: str, name: str = "rank") -> DataFrame:
    """Add a gapless 0-based rank in the given order, without a single-partition window.

    The rows are range-sorted and written once; the partition number and the position in
    it are written with them.  The offsets are one row per partition of that sort.
    """
    spark = df.sparkSession
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.withColumn("__at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("__at", 33)
    counts = sorted(
        (r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    )
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((int(p), total))
        total += n
    table = spark.createDataFrame(offsets, "__p long, __offset long")
    return (
        rows.withColumn("__p", part)
        .join(F.broadcast(table), "__p")  # one row per sort partition
        .withColumn(name, F.col("__offset") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__p", "__at", "__offset")
    )


# -- words of Arrow batches ---------------------------------------------------------------

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the hash base and of its inverse mod 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, b))])
                for b in (_BASE, inverse)
            )
        return self.up, self.down


_POWERS = _Powers()


def text_slices(column: pa.ChunkedArray | pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of runs of whole texts of about ``most`` bytes.

    Null texts are empty.  A text longer than ``most`` comes alone and whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and number of words per text, in order; no word crosses a text."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] |= inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = cuts[cuts > 0] - 1
    last[ends] |= inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, offsets)
    return starts, stops, np.diff(at)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    words = (sums[stops] - sums[starts]) * down[starts]
    return mix64(words + (stops - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles of each text, sorted per text, and their bounds.

    ASCII letters are lower-cased.  A text with fewer than ``width`` words has one shingle,
    its whole word sequence; a text without words has none.
    """
    data = _LOWER[data]
    starts, stops, counts = word_bounds(data, offsets)
    words = word_hashes(data, starts, stops)
    return shingle_sets(words, counts, width)


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    per_text = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(counts)
    begin = ends - counts
    out_ends = np.cumsum(per_text)
    total = int(out_ends[-1]) if len(out_ends) else 0
    owner = np.repeat(np.arange(len(counts)), per_text)
    at = np.arange(total) - (out_ends - per_text)[owner] + begin[owner]
    span = np.minimum(counts, width)[owner]
    value = span.astype(np.uint64)
    for k in range(width):
        use = k < span
        word = words[np.where(use, at + k, 0)] if total else words[:0]
        value = np.where(use, (value ^ word) * _U(0x9FB21C651E98DF25) + _U(k + 1), value)
        value = value ^ (value >> _U(32))
    value = mix64(value)
    for a, b in zip((out_ends - per_text).tolist(), out_ends.tolist()):
        value[a:b].sort()
    if total:
        new = np.ones(total, dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(counts) + 1))
    return value, bounds


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones of the same bits."""
    return x.view(np.int64)


LONG = T.LongType()
