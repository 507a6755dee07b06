"""MinHash near-dedup by a chosen-path set similarity join.

Every document is a set of word shingles.  Documents with equal sets are one class from the
start.  Each class has ``COORDINATES`` minwise tokens.  A *tree* starts with all classes at its
root and branches every node by the tokens of one chosen coordinate (a second one with
probability 1/threshold - 1, which keeps the expected number of surviving copies of a linked
pair near one at any depth; always a second one at the first ``WIDE_LEVELS`` levels below the
first, so that a pair goes down in several copies and does not die out by chance).  Nodes whose
sets fit in one piece are compared exhaustively; larger nodes are cut into pieces, each compared
exhaustively together with the node's leader, and branch again.  A node whose members already
share one component has nothing left to find and is dropped, so a dense group of copies closes
after a few linear passes instead of being expanded into pairs.  Independent trees repeat the
search: a pair at the threshold J meets in at least one of ``TREES`` first levels with
probability 1 - (1 - J)**TREES (0.9999997 at 0.85).  Nodes deeper than ``MAX_DEPTH`` are
compared exhaustively piece by piece.

A piece is compared twice.  First on its sketches: a member stays if it shares a band of minwise
tokens with a member of another component (a pair at the threshold fails to with a probability
of at most ``BAND_MISS``).  Then on the full sets of those that stayed, so that only sets with
a likely partner are shuffled.  The sets are written once, bucketed by their class.

Memory: a task holds one piece, about ``PIECE_SHINGLES`` hashes (more only for one document
that is longer), and compares it in blocks of rows whose dense matrices have about ``CELLS``
entries, however many short texts a piece has.  Nothing but counts and convergence sums reaches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import (
    connected_components,
    discard,
    materialize,
    mix64,
    shingles,
    signed,
    text_slices,
    whole_row,
)
from tidepool.session import delete_path, scratch_dir

COORDINATES = 64
TREES = 8
WORDS = 5
PIECE_SHINGLES = 400_000
CELLS = 1 << 22  # entries of a dense matrix
MAX_DEPTH = 16
WIDE_LEVELS = 3
BAND_MISS = 1e-6
KEY = ("n_shingles", "s1", "s2")
SLICE_BYTES = 1 << 20

_RNG = np.random.default_rng(7919)
_XOR = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# -- sets and sketches --------------------------------------------------------------------


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two sums per set that, with its size, name the set."""
    sums = np.zeros((len(bounds) - 1, 2), dtype=np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for j in range(2):
            sums[full, j] = np.add.reduceat(mix64(values + _XOR[j]), bounds[:-1][full])
    return sums


def band_width(percent: int) -> int:
    """Tokens of a band: as many as miss a pair at the threshold with ``BAND_MISS`` at most."""
    j = percent / 100
    fits = [r for r in range(2, 9) if (1 - j**r) ** (COORDINATES // r) <= BAND_MISS]
    return max(fits, default=1)


def bands(sketch: np.ndarray, width: int) -> np.ndarray:
    """Hashes (rows x bands) of runs of ``width`` coordinates of sketches."""
    many = COORDINATES // width
    out = np.zeros((len(sketch), many), dtype=np.uint64)
    for k in range(width):
        out = mix64(out + sketch[:, k : many * width : width].astype(np.uint64) + np.uint64(k + 1))
    return (out >> np.uint64(32)).astype(np.uint32)


def _sketch_batches(percent: int):
    width = band_width(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for a, b, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                values, bounds = shingles(data, offsets, WORDS)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                sketch = np.zeros((b - a, COORDINATES), dtype=np.uint32)
                if len(full):
                    at = bounds[:-1][full]
                    for j in range(COORDINATES):
                        low = np.minimum.reduceat((values ^ _XOR[j]) * _MUL[j], at)
                        sketch[full, j] = low >> np.uint64(32)
                sums = _sums(values, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(signed(sums[:, 0].copy())),
                        pa.array(signed(sums[:, 1].copy())),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(b - a + 1, dtype=np.int32) * COORDINATES),
                            pa.array(sketch.ravel().view(np.int32)),
                        ),
                        pa.array([row.tobytes() for row in bands(sketch, width)], pa.binary()),
                    ],
                    names=["doc_id", *KEY, "sketch", "bands"],
                )

    return run


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of rows whose text has the set that the row's class names."""
    for batch in batches:
        rep = batch.column("rep").to_numpy(zero_copy_only=False)
        named = [batch.column(k).to_numpy(zero_copy_only=False) for k in KEY]
        for a, b, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            values, bounds = shingles(data, offsets, WORDS)
            sums = _sums(values, bounds)
            own = np.diff(bounds) == named[0][a:b]
            for j in range(2):
                own &= signed(sums[:, j].copy()) == named[j + 1][a:b]
            keep = np.flatnonzero(own)
            packed = [values[bounds[k] : bounds[k + 1]].tobytes() for k in keep.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[a:b][keep]), pa.array(packed, pa.binary())], names=["rep", "shingles"]
            )


# -- comparing one piece ------------------------------------------------------------------


def linked_pairs(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i < j) of all sets with 100 * intersection >= percent * union."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = 100 * common >= percent * (sizes.sum() - common)
        return (np.array([0]), np.array([1])) if hit else (np.zeros(0, int), np.zeros(0, int))
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    token = np.cumsum(new) - 1
    shared = np.bincount(token)[token] > 1
    token, owner = token[shared], owner[shared]
    if len(token):
        token = np.unique(token, return_inverse=True)[1]
    by_owner = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[by_owner], np.arange(n + 1))
    rows = max(1, min(256, CELLS // n))
    left, right = [], []
    for a in range(0, n, rows):
        b = min(a + rows, n)
        mine = np.unique(token[by_owner[ends[a] : ends[b]]])
        if not len(mine):
            continue
        local = np.full(token[-1] + 1, -1, dtype=np.int64)
        local[mine] = np.arange(len(mine))
        use = np.flatnonzero((local[token] >= 0) & (owner >= a))
        column, row = local[token[use]], owner[use] - a
        width = max(64, min(4096, CELLS // (n - a)))
        cuts = np.searchsorted(column, np.arange(0, len(mine) + width, width))
        common = np.zeros((b - a, n - a), dtype=np.float32)
        for w, (c, d) in enumerate(zip(cuts[:-1], cuts[1:])):
            block = np.zeros((n - a, width), dtype=np.float32)
            block[row[c:d], column[c:d] - w * width] = 1
            common += block[: b - a] @ block.T  # counts below 2**24 are exact
        common = common.astype(np.int64)
        union = sizes[a:b, None] + sizes[None, a:] - common
        i, j = np.nonzero(np.triu(100 * common >= percent * union, 1))
        left.append(i + a)
        right.append(j + a)
    if not left:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(left), np.concatenate(right)


def spanning(component: list[int], i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges (u, v) between components that join the same ones as the links i-j."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist()):
        u, v = root(component[a]), root(component[b])
        if u != v:
            u, v = max(u, v), min(u, v)
            parent[u] = v
            out.append((u, v))
    return out


def _whole_pieces(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames sorted by (node, piece), cut anew so that no piece is in two, and their pieces' starts."""
    rest = None

    def starts(frame: pd.DataFrame) -> np.ndarray:
        keys = frame[["node", "piece"]].to_numpy()
        return np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])

    for frame in frames:
        if not len(frame):
            continue
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        at = starts(frame)
        rest = frame.iloc[at[-1] :]
        if len(at) > 1:
            yield frame.iloc[: at[-1]], at[:-1]
    if rest is not None:
        yield rest, np.zeros(1, dtype=np.int64)


def _likely(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that share a band with a row of their piece that is of another component."""
    for frame, at in _whole_pieces(frames):
        component = frame["component"].to_numpy()
        piece = np.zeros(len(frame), dtype=np.uint64)
        piece[at[1:]] = 1
        piece = np.cumsum(piece, dtype=np.uint64) << np.uint64(32)
        table = np.frombuffer(b"".join(frame["bands"]), dtype=np.uint32).reshape(len(frame), -1)
        keep = np.zeros(len(frame), dtype=bool)
        for k in range(table.shape[1]):
            key = piece | table[:, k]
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
            first = np.flatnonzero(new)
            mixed = np.minimum.reduceat(component[order], first) < np.maximum.reduceat(component[order], first)
            keep[order] |= mixed[np.cumsum(new) - 1]
        if keep.any():
            yield frame.loc[keep, ["node", "piece", "rep", "component"]]


def _compare_pieces(percent: int):
    """mapInPandas over rows sorted by (node, piece): the component edges found in each piece."""

    def one(rows: pd.DataFrame) -> list[tuple[int, int]]:
        component = rows["component"].tolist()
        if len(component) < 2 or len(set(component)) < 2:
            return []
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["shingles"]]
        return spanning(component, *linked_pairs(sets, percent))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, at in _whole_pieces(frames):
            out: list[tuple[int, int]] = []
            for start, end in zip(at.tolist(), [*at[1:].tolist(), len(frame)]):
                out += one(frame.iloc[start:end])
            if out:
                yield pd.DataFrame(out, columns=["u", "v"])

    return run


# -- the join -----------------------------------------------------------------------------


def _ways(node: str, percent: int):
    """A second way with probability 1/threshold - 1."""
    extra = int((100 / percent - 1) * 1000)
    return F.when(F.pmod(F.xxhash64(node, F.lit("branch")), F.lit(1000)) < extra, 2).otherwise(1)


def _children(rows: DataFrame, percent: int, depth: int) -> DataFrame:
    """The child nodes of every row's node, by the tokens of chosen coordinates.

    The first level has the coordinates divisible by 4; those below it take turns with the
    other three remainders, so that a path does not meet a coordinate again soon.
    """
    take = F.lit(2) if depth <= WIDE_LEVELS else _ways("node", percent)
    turn = F.pmod(F.xxhash64("node") + F.col("way") * 5, F.lit(COORDINATES // 4)).cast("int")
    return (
        rows.withColumn("way", F.explode(F.sequence(F.lit(1), take)))
        .withColumn("at", F.lit(1 + (depth - 1) % 3) + 4 * turn)
        .select(
            F.xxhash64("node", "way", F.get("sketch", F.col("at"))).alias("node"),
            "rep",
            "n_shingles",
        )
        .distinct()
    )


def _equal_sets(keyed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes ``(*KEY, low, rep)`` of equal sets, and labels of those that share a doc_id.

    ``low`` is the class's smallest doc_id and ``rep`` its name: the same number, or one above
    all ids where another class has the same smallest id.
    """
    classes = materialize(keyed.groupBy(*KEY).agg(F.min("doc_id").alias("low")), "op1-classes")
    key = F.struct(*KEY)
    held = keyed.where("doc_id is not null").groupBy("doc_id")
    shared = held.agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a <> b").select("doc_id")
    shared = materialize(shared, "op1-shared")
    if shared.isEmpty():
        return classes.withColumn("rep", F.col("low")), None
    top = keyed.agg(F.max("doc_id")).first()[0]
    first = classes.where("low is not null").groupBy("low").agg(F.min(key).alias("first"))
    named = classes.join(first, "low", "left").withColumn(
        "rep",
        F.when(F.col("first") != key, F.lit(top + 1) + F.monotonically_increasing_id()).otherwise(F.col("low")),
    )
    named = materialize(named.select(*KEY, "low", "rep"), "op1-classes")
    rows = keyed.join(shared, "doc_id").join(named, list(KEY)).select("doc_id", "rep").distinct()
    least = rows.groupBy("doc_id").agg(F.min("rep").alias("v"))
    joined = connected_components(rows.join(least, "doc_id").select(F.col("rep").alias("u"), "v"), "op1-edges")
    return named, materialize(joined.select(F.col("v").alias("rep"), "component"), "op1-labels")


def near_duplicates(docs: DataFrame, percent: int = 85, trees: int = TREES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs(doc_id, text, ...)``.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of distinct
    ``WORDS``-word shingles (ASCII lower-cased; a shorter text is one shingle); links are
    confirmed on the full sets.  Defined results: a null or wordless text has no shingles and
    is linked with nothing; repeated rows come back once each; rows that share a doc_id are one
    vertex, linked by each of their texts; a row without doc_id takes the component of the
    documents with the same set, else null, and is kept only then; an empty table gives an empty
    result; other columns are ignored.  Where ids are shared by different texts, they are at most 2**62.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = materialize(
        base.mapInArrow(
            _sketch_batches(percent),
            "doc_id long, n_shingles long, s1 long, s2 long, sketch array<int>, bands binary",
        ),
        "op1-sketch",
    )
    keyed = sketched.where("n_shingles > 0")
    classes, labels = _equal_sets(keyed)

    # members of the first level of every tree that share a node with another class; the id is
    # part of the join's key, so the copies of a class are spread over tasks
    named = classes.where("rep is not null").withColumnRenamed("low", "doc_id")
    sketches = keyed.join(named, [*KEY, "doc_id"]).select("doc_id", *KEY, "rep", "sketch", "bands")
    roots = sketches.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(trees))))
    first = roots.withColumn("way", F.explode(F.sequence(F.lit(1), F.lit(2))))
    first = first.where(F.col("way") <= _ways("tree", percent))
    # the first coordinates of the trees are distinct
    stride = COORDINATES // (2 * trees) or 1
    at = ((F.col("tree") - 1) * 2 + F.col("way") - 1) * stride
    first = first.select(
        "tree",
        F.xxhash64("tree", "way", F.get("sketch", at.cast("int"))).alias("node"),
        "rep",
        "n_shingles",
    ).distinct()
    shared = first.groupBy("node").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    first = first.join(shared.where("a < b").select("node"), "node")
    first = materialize(first, "op1-first")

    # read by every round, so written once, for members of nodes only
    sketches = sketches.join(first.select("rep").distinct(), "rep", "left_semi")
    sketches = materialize(sketches.dropDuplicates(["rep"]), "op1-sketches")
    sets = base.join(sketches.select("doc_id", *KEY, "rep"), "doc_id").select("rep", *KEY, "text")
    sets = sets.mapInArrow(_set_batches, "rep long, shingles binary").dropDuplicates(["rep"])
    table, path = f"op1_sets_{uuid.uuid4().hex}", scratch_dir(spark, "op1-sets")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = sets.repartition(buckets, "rep").write.bucketBy(buckets, "rep").sortBy("rep")
    sets.option("path", path).format("parquet").saveAsTable(table)
    sets = spark.table(table)

    frontier, depth = None, 0
    schedule = [[1], list(range(2, trees // 2 + 1)), list(range(trees // 2 + 1, trees + 1))]
    while frontier is not None or depth < len(schedule):
        now = first.where(F.col("tree").isin(schedule[depth])) if depth < len(schedule) else None
        now = now.select("node", "rep", "n_shingles") if now is not None else None
        if frontier is not None:
            now = frontier if now is None else now.union(frontier)
        depth += 1
        if labels is not None:
            now = now.join(labels, "rep", "left")
        else:
            now = now.withColumn("component", F.lit(None).cast("long"))
        now = now.withColumn("component", F.coalesce("component", "rep"))
        stats = now.groupBy("node").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum("n_shingles").alias("weight"),
            F.min(F.col("rep").bitwiseXOR(F.xxhash64("node"))).alias("lead"),
        )
        stats = stats.where("low < high").select(
            "node",
            F.ceil(F.col("weight") / PIECE_SHINGLES).cast("int").alias("pieces"),
            F.col("lead").bitwiseXOR(F.xxhash64("node")).alias("lead"),
        )
        now = materialize(now.join(stats, "node"), "op1-open")
        discard(frontier)
        frontier = None
        size = now.agg(F.max("pieces").alias("most")).first()["most"]
        if size is None:
            discard(now)
            continue
        own = F.pmod(F.xxhash64("rep", "node"), F.col("pieces")).cast("int")
        dealt = now.withColumn("own", own)
        if depth >= MAX_DEPTH and size > 1:
            # every pair of pieces once: the exact way for nodes that do not split
            other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
            dealt = dealt.withColumn("other", other).withColumn(
                "piece",
                F.least("own", "other").cast("long") * (1 << 31) + F.greatest("own", "other"),
            )
        else:
            # the leader of a node is compared in each of its pieces
            lead = F.when(
                F.col("rep") == F.col("lead"), F.sequence(F.lit(0), F.col("pieces") - 1)
            ).otherwise(F.array("own"))
            dealt = dealt.withColumn("piece", F.explode(lead))
        dealt = dealt.select("node", F.col("piece").cast("long"), "rep", "component")
        likely = dealt.join(sketches.select("rep", "bands"), "rep")
        likely = likely.repartition("node", "piece").sortWithinPartitions("node", "piece")
        likely = likely.select("node", "piece", "rep", "component", "bands").mapInPandas(
            _likely, "node long, piece long, rep long, component long"
        )
        pieces = likely.join(sets, "rep").repartition("node", "piece").sortWithinPartitions("node", "piece")
        edges = pieces.select("node", "piece", "component", "shingles").mapInPandas(
            _compare_pieces(percent), "u long, v long"
        )
        joined = connected_components(edges, "op1-edges")
        before = labels
        if labels is None:
            labels = joined.select(F.col("v").alias("rep"), "component")
        else:
            known = labels.withColumnRenamed("component", "v").join(joined, "v", "left")
            known = known.select("rep", F.coalesce("component", "v").alias("component"))
            fresh = joined.select(F.col("v").alias("rep"), "component").join(labels, "rep", "left_anti")
            labels = known.union(fresh)
        labels = materialize(labels, "op1-labels")
        discard(before)
        if size > 1 and depth < MAX_DEPTH:
            large = now.where("pieces > 1").select("node", "rep", "n_shingles")
            large = large.join(sketches.select("rep", "sketch"), "rep")
            frontier = materialize(_children(large, percent, depth), "op1-frontier")
        discard(now)
    discard(first, sketches)
    spark.sql(f"DROP TABLE {table}")
    delete_path(spark, path)

    if labels is not None:
        classes = classes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        classes = classes.withColumn("component", F.col("rep"))
    out = sketched.select("doc_id", *KEY).join(classes.select(*KEY, "component"), list(KEY), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def one_of_each_group(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` without near copies of another: of each group one row stays.

    It is the one with the smallest doc_id (a row without id only where none has one), of
    equal ids the first as written.  Every row is a vertex of its own, so texts that share an
    id without being alike all stay, and rows without id are compared as well.  Rows without
    words are no copies.  All columns come back; an empty table gives an empty result.
    """
    numbered = docs.select(whole_row(docs), F.monotonically_increasing_id().alias("row"))
    numbered = materialize(numbered, "op1-rows")
    groups = near_duplicates(
        numbered.select(F.col("row").alias("doc_id"), F.col("doc")["text"].alias("text")), percent
    ).select(F.col("doc_id").alias("row"), "component_id")
    ids = numbered.select("row", F.col("doc")["doc_id"].alias("id"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    first = groups.join(ids, "row").groupBy("component_id").agg(F.min(order).alias("first"))
    return numbered.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")
