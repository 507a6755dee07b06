"""Embedding near-dedup by collision counting on sorted projections.

Vectors of one label are projected on ``PROJECTIONS`` random directions.  For a pair with
cosine c the difference of a projection is normal with deviation sqrt(2 - 2c), so the chance of
a collision in a window of half-width ``WINDOW`` around the query is known at the threshold, and
a linked pair collides in at least ``count_needed`` of the projections except with probability
``MISS``.  Pairs that reach the count are verified by cosine in double precision.

To keep windows short at any size, each of several tables first buckets a label's vectors by a
few quantised directions (``cells``: as many as bring a bucket of unrelated vectors of this label
down to ``BUCKET`` rows) and sorts every bucket along one projection.  ``tables_needed(cells)``
tables are drawn, so many that a pair at the threshold *meets* in none of them with probability
``MISS`` at most, at every size of the label: it meets in a table if it shares the cell and its
places on the table's own line differ by ``WINDOW`` at most.  With the count above, a pair at the
threshold is found with probability 1 - 2 * ``MISS`` at least.  The sorted run is cut into blocks; a block
is compared with itself and with the later blocks that its windows reach.  All
projections are counted inside the block pair, so no pair leaves a task: a task returns link
counts per vector and the edges of a spanning forest.  A pair that meets in several tables is
counted in the first of them only, and in none where it does not meet.

The sorted rows of all tables are numbered by global rank and cut into chunks of ``CHUNK`` rows.
A chunk is compared with itself and, if its last bucket goes on, with the later chunks that the
windows of that bucket reach; only rows within the reach go along.  The chunk pair is the shuffle
key, so a dense group is spread over tasks by its chunk pairs, whatever its size.

Equal vectors are collapsed before and count with their number.  Memory: two chunks of ``CHUNK``
rows a task, compared in steps of two blocks of ``BLOCK`` rows.  A dense group of n distinct near
copies costs n * n / 2 verifications (each vector's links are counted).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import connected_components, materialize, with_global_rank
from tidepool.llm.minhash_dedup import spanning

COSINE = 0.98
PROJECTIONS = 24
WINDOW = 0.5  # 2.5 deviations at the threshold
REACH = WINDOW + 1e-6  # blocks are dropped only well past the window
CELL = 0.9  # width of a quantised direction, 4.5 deviations at the threshold
MISS = 1e-4
BUCKET = 256
BLOCK = 512
CHUNK = 4096
SEED = 4242
KEYS = ["label", "size", "table", "bucket"]


def count_needed() -> int:
    """The least collision count that a pair at the threshold reaches but for ``MISS``."""
    p = math.erf(WINDOW / math.sqrt(2 - 2 * COSINE) / math.sqrt(2))
    below = 0.0
    for k in range(PROJECTIONS + 1):
        below += math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)
        if below > MISS:
            return k
    return PROJECTIONS


def cell_chance() -> float:
    """The probability that a pair at the threshold shares the cell of one direction."""
    deviation = math.sqrt(2 - 2 * COSINE)
    x = CELL / deviation
    inside = math.erf(x / math.sqrt(2))
    return inside - math.sqrt(2 / math.pi) / x * (1 - math.exp(-x * x / 2))


def tables_needed(cells: int) -> int:
    """The number of tables in which a pair at the threshold meets but for ``MISS``."""
    meet = cell_chance() ** cells * math.erf(WINDOW / math.sqrt(2 - 2 * COSINE) / math.sqrt(2))
    return math.ceil(math.log(MISS) / math.log1p(-meet))


_DIRECTIONS: dict = {}


def directions(dimension: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Projection directions; directions and shifts of the cells, and the line, of every table."""
    if (dimension, cells) not in _DIRECTIONS:
        lines, cell, shift, line = (np.random.default_rng([SEED, dimension, k]) for k in range(4))
        tables = tables_needed(cells)
        _DIRECTIONS[dimension, cells] = (
            lines.standard_normal((dimension, PROJECTIONS)),
            cell.standard_normal((tables, dimension, cells)),
            shift.uniform(0, CELL, (tables, cells)),
            line.standard_normal((dimension, tables)),
        )
    return _DIRECTIONS[dimension, cells]


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return vectors / norms[:, None]


def cells_of(units: np.ndarray, cells: int) -> np.ndarray:
    """One 64-bit bucket code per row and table."""
    _, cell, shift, _ = directions(units.shape[1], cells)
    out = np.zeros((len(units), len(cell)), dtype=np.int64)
    for t in range(len(cell)):
        grid = np.floor((units @ cell[t] + shift[t]) / CELL).astype(np.int64)
        code = np.full(len(units), t + 1, dtype=np.int64)
        for k in range(cells):
            code = code * np.int64(1_000_003) + grid[:, k]
        out[:, t] = code
    return out


def places_of(units: np.ndarray, cells: int) -> np.ndarray:
    """The place of every row on the line of every table."""
    return units @ directions(units.shape[1], cells)[3]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(label, size, cells, table, bucket, place, row) by vector and table."""
    for frame in frames:
        for (size, cells), part in frame.groupby(["size", "cells"]):
            for a in range(0, len(part), 2048):
                rows = part.iloc[a : a + 2048]
                units = unit(_matrix(rows["embedding"]))
                codes, places = cells_of(units, cells), places_of(units, cells)
                for t in range(codes.shape[1]):
                    out = rows[["label", "size", "cells", "row"]].copy()
                    out["table"] = t
                    out["bucket"] = codes[:, t]
                    out["place"] = places[:, t]
                    yield out


def _links():
    """mapInPandas over rows sorted by (first, second, side, label, size, table, bucket, place)."""
    needed = count_needed()

    def block(rows: pd.DataFrame) -> dict:
        units = unit(_matrix(rows["embedding"]))
        cells = int(rows["cells"].iloc[0])
        lines = directions(units.shape[1], cells)[0]
        return {
            "units": units,
            "lines": (units @ lines).astype(np.float32),
            "codes": cells_of(units, cells),
            "places": places_of(units, cells),
            "ids": rows["vec_id"].to_numpy(np.int64),
            "copies": rows["copies"].to_numpy(np.int64),
            "place": rows["place"].to_numpy(np.float64),
        }

    def part(rows: dict, a: int, b: int) -> dict:
        return {name: values[a:b] for name, values in rows.items()}

    def compare(a: dict, b: dict, table: int) -> pd.DataFrame | None:
        collisions = np.zeros((len(a["ids"]), len(b["ids"])), dtype=np.int16)
        for k in range(PROJECTIONS):
            collisions += np.abs(a["lines"][:, k, None] - b["lines"][None, :, k]) <= WINDOW
        i, j = np.nonzero(collisions >= needed)
        if a is b:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return None
        near = np.abs(a["places"][i, : table + 1] - b["places"][j, : table + 1]) <= WINDOW
        earlier = ((a["codes"][i, :table] == b["codes"][j, :table]) & near[:, :table]).any(axis=1)
        first = near[:, table] & ~earlier
        i, j = i[first], j[first]
        cosine = np.einsum("ij,ij->i", a["units"][i], b["units"][j])
        i, j = i[cosine >= COSINE], j[cosine >= COSINE]
        if not len(i):
            return None
        ids = np.concatenate([a["ids"][i], b["ids"][j]])
        weight = np.concatenate([b["copies"][j], a["copies"][i]])
        names, at = np.unique(ids, return_inverse=True)
        links = np.bincount(at, weights=weight).astype(np.int64)
        edges = spanning(names.tolist(), at[: len(i)], at[len(i) :])
        counts = pd.DataFrame({"vec_id": names, "links": links, "other": pd.array([None] * len(names), "Int64")})
        forest = pd.DataFrame(edges, columns=["vec_id", "other"])
        forest["links"] = 0
        return pd.concat([counts, forest.astype({"other": "Int64"})], ignore_index=True)[
            ["vec_id", "links", "other"]
        ]

    def blocks(rows: pd.DataFrame) -> list[dict]:
        """The blocks of rows of one bucket."""
        return [block(rows.iloc[a : a + BLOCK]) for a in range(0, len(rows), BLOCK)]

    def buckets(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
        names = rows[KEYS].to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)])

    def within(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The links inside the buckets of one chunk."""
        table = rows["table"].to_numpy()
        kinds = rows[["size", "cells"]].to_numpy()
        spans = [(a, b) for a, b in buckets(rows) if b - a > 1]
        prepared, begin, until = None, 0, 0
        for a, b in spans:
            for s in range(a, b, BLOCK):
                if min(s + BLOCK, b) > until:  # project many rows of one kind at once
                    begin, until = s, min(s + 8 * BLOCK, len(rows))
                    until = begin + int(np.argmax(np.append((kinds[begin:until] != kinds[begin]).any(axis=1), True)))
                    prepared = block(rows.iloc[begin:until])
                now = part(prepared, s - begin, min(s + BLOCK, b) - begin)
                opened = [] if s == a else [x for x in opened if x["place"][-1] >= now["place"][0] - REACH]
                opened.append(now)
                for x in opened:
                    if (found := compare(x, now, int(table[a]))) is not None:
                        yield found

    def across(early: pd.DataFrame, late: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The links between two chunks, whose rows here are of one bucket."""
        if not len(early) or not len(late):
            return
        firsts, table = blocks(early), int(early["table"].iloc[0])
        for now in blocks(late):
            for x in firsts:
                if x["place"][-1] >= now["place"][0] - REACH:
                    if (found := compare(x, now, table)) is not None:
                        yield found

    def one(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if rows["first"].iloc[0] == rows["second"].iloc[0]:
            yield from within(rows)
        else:
            late = rows["side"].to_numpy() == 1
            yield from across(rows[~late], rows[late])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            names = frame[["first", "second"]].to_numpy()
            cuts = (np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist()
            if rest and tuple(rest[0][["first", "second"]].iloc[0]) != tuple(names[0]):
                yield from one(pd.concat(rest, ignore_index=True))
                rest = []
            for a, b in zip([0, *cuts[:-1]], cuts):
                yield from one(pd.concat([*rest, frame.iloc[a:b]], ignore_index=True))
                rest = []
            rest.append(frame.iloc[cuts[-1] if cuts else 0 :])
        if rest:
            yield from one(pd.concat(rest, ignore_index=True))

    return run


def chunk_pairs(ranked: DataFrame) -> DataFrame:
    """Rows of ``ranked`` (with ``rank``) by the pairs (first, second) of chunks to compare.

    Side 0 are the rows of the first chunk, side 1 those of the second.
    """
    rows = ranked.withColumn("chunk", F.floor(F.col("rank") / CHUNK))
    at = F.struct("rank", *KEYS, "place")
    ends = rows.groupBy("chunk").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    ends = materialize(ends, "op4-chunks")
    early = ends.select(
        F.col("chunk").alias("first"), *(F.col(f"high.{k}").alias(k) for k in KEYS), F.col("high.place").alias("last")
    )
    late = ends.select(
        F.col("chunk").alias("second"), *(F.col(f"low.{k}").alias(k) for k in KEYS), F.col("low.place").alias("begin")
    )
    pairs = early.join(late, KEYS).where((F.col("first") < F.col("second")) & (F.col("begin") <= F.col("last") + REACH))
    pairs = materialize(pairs, "op4-pairs")
    columns = ["first", "second", "side", *ranked.columns]
    own = rows.withColumn("first", F.col("chunk")).withColumn("second", F.col("chunk")).withColumn("side", F.lit(0))
    left = (
        rows.join(pairs.withColumn("chunk", F.col("first")), ["chunk", *KEYS])
        .where(F.col("place") >= F.col("begin") - REACH)
        .withColumn("side", F.lit(0))
    )
    right = (
        rows.join(pairs.withColumn("chunk", F.col("second")), ["chunk", *KEYS])
        .where(F.col("place") <= F.col("last") + REACH)
        .withColumn("side", F.lit(1))
    )
    return own.select(columns).union(left.select(columns)).union(right.select(columns)).drop("rank")


def _scaled(vector: Column) -> Column:
    """Finite vectors whose squares leave the range of doubles, times a power of two.

    The power brings the largest component near 1.  It is applied in two halves, each a
    normal number, and changes no direction; other vectors stay as they are.
    """
    most = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    power = -F.floor(F.log2(most))
    half = F.floor(power / 2)
    by = lambda n: F.pow(F.lit(2.0), n.cast("double"))
    return F.when(most.between(1e-100, 1e100), vector).otherwise(
        F.transform(vector, lambda x: x * by(half) * by(power - half))
    )


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding, label)``.

    Vectors are linked if their labels are equal and their cosine is at least ``COSINE`` (found
    pairs are verified in double precision; recall by the calibration above).  Defined results:
    null, empty, zero and non-finite vectors (or components) and null labels link with nothing;
    vectors of different lengths link with nothing; equal vectors are linked; rows that share a
    vec_id are one vertex of the components; a null vec_id links with nothing; an empty table
    gives an empty result; other columns are ignored.
    """
    value = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        value.alias("embedding"),
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False)
    )
    rows = rows.withColumn("usable", usable)
    rows = rows.withColumn("embedding", F.when(F.col("usable"), _scaled(F.col("embedding"))))
    rows = rows.withColumn("same", F.when(F.col("usable"), F.sha2(F.to_json(F.struct("label", "embedding")), 256)))
    rows = materialize(rows, "op4-rows")
    classes = (
        rows.where("usable").groupBy("same").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    )
    classes = materialize(classes, "op4-classes")
    singles = (
        rows.where("usable")
        .join(classes, "same")
        .where("vec_id = class_id")
        .dropDuplicates(["same"])
        .select("label", "vec_id", "copies", "embedding", F.size("embedding").alias("size"))
    )
    singles = materialize(singles.withColumn("row", F.monotonically_increasing_id()), "op4-singles")
    # an unrelated pair shares a cell of one direction with probability of about 0.36
    counts = singles.groupBy("label", "size").agg(F.count("*").alias("n")).where("n > 1")
    depth = F.ceil(F.log(F.greatest(F.col("n") / BUCKET, F.lit(1.0))) / math.log(1 / 0.36))
    counts = counts.select("label", "size", depth.cast("int").alias("cells"))
    placed = singles.join(counts, ["label", "size"]).mapInPandas(
        _expand,
        T.StructType.fromDDL("label string, size int, cells int, row long, table int, bucket long, place double"),
    )
    placed = materialize(placed, "op4-places")
    ranked = with_global_rank(placed, [*KEYS, "place", "row"], "op4-ranks")
    dealt = chunk_pairs(ranked).join(singles.select("row", "vec_id", "copies", "embedding"), "row")
    dealt = dealt.repartition("first", "second").sortWithinPartitions("first", "second", "side", *KEYS, "place", "row")
    found = materialize(dealt.mapInPandas(_links(), "vec_id long, links long, other long"), "op4-links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("vec_id").alias("u"), F.col("other").alias("v"))
    # rows that share a vec_id but not the vector join their classes
    shared = rows.where("usable").select("vec_id", "same").distinct().join(classes, "same")
    shared = shared.where("vec_id <> class_id").select(F.col("vec_id").alias("u"), F.col("class_id").alias("v"))
    components = connected_components(edges.union(shared), "op4-components")
    out = (
        rows.select("vec_id", "usable", "same")
        .join(classes, "same", "left")
        .join(links.withColumnRenamed("vec_id", "class_id"), "class_id", "left")
        .join(components.withColumnRenamed("v", "vec_id"), "vec_id", "left")
    )
    return out.select(
        "vec_id",
        F.when(F.col("usable"), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
