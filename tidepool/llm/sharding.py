"""Sharding by a Hilbert curve over several metadata dimensions.

Language, source, text size and id are each quantised to ``2**BITS`` levels: numbers at
approximate quantiles, strings by the rank of the whole string among the distinct ones (at most
``2**BITS`` boundaries a dimension).  The cells are visited along a
Hilbert curve, rows are sorted by curve index, and the sorted run is cut into shards whose row
counts differ by one at most.  Neighbours on the curve are neighbours in every dimension, so
each shard (and each file written in that order) spans a small range of all of them and
min/max statistics prune files for predicates on any.

The sort is a range sort with the id and a row number as last keys, so equal cells and copies
split freely over tasks; ranks come from the row counts of the sorted partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import whole_row, with_global_rank

BITS = 8
SHARDS = 8
QUANTILE_ERROR = 1.0 / 1024
DIMENSIONS = ("lang", "source", "size", "doc_id")


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points (rows x dimensions) below ``2**bits``.

    Follows the published transform between axes and the transposed index: undo the excess
    rotations from the highest bit down, Gray-encode, then interleave the bits.
    """
    x = [axes[:, k].astype(np.int64) for k in range(axes.shape[1])]
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for k in range(n):
            high = (x[k] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
        level >>= 1
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where((x[n - 1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            out = (out << 1) | (((x[k] ^ flip) >> bit) & 1)
    return out


def string_cuts(docs: DataFrame, name: str, levels: int = 1 << BITS) -> np.ndarray:
    """Fewer than ``levels`` strings that cut the sorted distinct values into runs of equal number.

    With fewer distinct values than that each has a run of its own; level 0 is left to nulls.
    """
    values = docs.where(F.col(name).isNotNull()).select(name).distinct()
    ranked = with_global_rank(values, [F.col(name)], "op7-names")
    runs = max(1, levels - 2)
    # the largest of each run: a value is above the cuts of all runs before its own
    place = F.floor((F.col("rank") + 1) * runs / F.lit(max(runs, ranked.count())))
    cuts = ranked.where(place > F.floor(F.col("rank") * runs / F.lit(max(runs, ranked.count()))))
    return np.array(sorted(r[0] for r in cuts.select(name).collect()), dtype=object)


def _string_level(cuts: np.ndarray, column: pd.Series) -> np.ndarray:
    codes, values = pd.factorize(column)
    found = np.searchsorted(cuts, np.asarray(values, dtype=object), side="left") + 1
    return np.append(found, 0)[codes].astype(np.int64)


def with_curve_index(docs: DataFrame) -> DataFrame:
    """``docs(lang, source, size, doc_id, ...)`` with the Hilbert index of each row's cell."""
    numbers = docs.withColumns(
        {
            "__d2": F.log1p(F.col("size").cast("double")),
            "__d3": F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)),
        }
    )
    levels = 1 << BITS
    cuts = numbers.select("__d2", "__d3").approxQuantile(
        ["__d2", "__d3"], [k / levels for k in range(1, levels)], QUANTILE_ERROR
    )
    edges = [np.array(c, dtype=float) for c in cuts]
    names = [string_cuts(docs, c) for c in DIMENSIONS[:2]]

    @F.pandas_udf("long")
    def index(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            axes = [_string_level(cut, c) for cut, c in zip(names, columns[:2])]
            axes += [np.searchsorted(e, c.to_numpy(), side="left") for e, c in zip(edges, columns[2:])]
            yield pd.Series(hilbert_index(np.stack(axes, axis=1), BITS))

    return numbers.withColumn("curve", index("lang", "source", "__d2", "__d3")).drop("__d2", "__d3")


def _place(total: int, shards: int) -> tuple[Column, Column]:
    """Shard of a ``rank`` and the first rank of a ``shard``; row counts are at most one apart."""
    small, larger = divmod(total, shards)
    edge = larger * (small + 1)
    rank = F.col("rank")
    place = F.when(rank < edge, F.floor(rank / (small + 1))).otherwise(
        larger + F.floor((rank - edge) / max(small, 1))
    )
    first = F.when(F.col("shard") < larger, F.col("shard") * (small + 1)).otherwise(
        edge + (F.col("shard") - larger) * small
    )
    return place.cast("int"), first


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Place every row of ``docs(doc_id, text, lang, source, ...)`` in one of ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law (``rows``: row counts
    are at most one apart), shard, slot (gapless from 0 in the shard), grown_shard (null) and
    curve.  Defined results: a null text has size 1 and the crc32 of the empty string; null
    languages, sources and ids come first in their dimension; ties on the curve are ordered by
    id, then as read; repeated rows get a place each; an empty table gives an empty result;
    other columns are ignored.
    """
    raw = F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("__row"),
    )
    curved = with_curve_index(rows).drop("lang", "source")
    order = [F.col("curve"), F.col("doc_id"), F.col("__row")]
    ranked = with_global_rank(curved, order, "op7-order")
    total = ranked.count()
    place, first = _place(total, shards)
    return ranked.withColumn("shard", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as Parquet, one folder per shard, rows in curve order within each file.

    The shards are those of ``shard``.  All columns of ``docs`` are written; the folders are
    named ``shard=k``, with underscores before the name where ``docs`` has such a column.  An
    empty table writes no rows.
    """
    raw = F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b""))
    rows = docs.select(
        whole_row(docs),
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("__row"),
    )
    curved = with_curve_index(rows).drop("lang", "source", "size")
    order = [F.col("curve"), F.col("doc_id"), F.col("__row")]
    ranked = with_global_rank(curved, order, "op7-order")
    placed = ranked.withColumn("shard", _place(ranked.count(), shards)[0]).sortWithinPartitions("shard", "rank")
    folder = "shard"
    while folder.lower() in {c.lower() for c in docs.columns}:
        folder = f"_{folder}"
    placed.select("doc.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
