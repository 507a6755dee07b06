"""Benchmark decontamination by a broadcast hash set of test n-grams.

Test items and documents are normalised to the same words (ASCII lower-cased; digits, letters
and everything beyond ASCII).  A window is ``WIDTH`` consecutive words of an item; an item with
fewer words is one window.  Each window is a 64-bit hash, looked up first, and a SHA-256 of its words,
which verifies every hit.  Documents are scanned in numpy: rolling hashes of all windows of the
lengths in use, a bit table, then the sorted hashes, then the words themselves.

The set is broadcast only in blocks of ``BLOCK_WINDOWS`` fixed-size rows.  A larger benchmark takes
several scans, one block after the other, each adding to the hits of the last, through a written
table; so the result is the same, and memory is bounded, for a benchmark of any size.  Documents are
never shuffled, and a passage in a third of all documents costs its own documents only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import _LOWER, materialize, mix64, text_slices, word_hashes

WIDTH = 10
BLOCK_WINDOWS = 1 << 18
SLICE_BYTES = 1 << 20
WINDOWS = "length int, hash long, digest binary, item string"
FOUND = "n_words long, hits array<struct<start:long,end:long>>, items array<string>, clean string"

_U = np.uint64
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


# -- words and windows of a slice of texts ------------------------------------------------


class Words:
    """The words of some whole texts: bounds in bytes, owners, hashes, joined forms."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = data = _LOWER[data]
        n = len(data)
        inside = _INSIDE[data]
        border = np.zeros(n + 1, dtype=bool)
        border[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | border[1:n]
        last[:-1] &= ~inside[1:] | border[1:n]
        self.starts, self.stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i] to bounds[i + 1]
        self.counts = np.diff(self.bounds)
        self.hashes = word_hashes(data, self.starts, self.stops)
        self.origins = offsets[:-1]
        self._inside, self._flat = inside, None

    def __len__(self) -> int:
        return len(self.starts)

    def windows(self, lengths: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, hashes) of the windows of each length, none across texts."""
        at = np.arange(len(self))
        end = np.repeat(self.bounds[1:], self.counts)
        value = np.full(len(self), 0x9E3779B97F4A7C15, dtype=np.uint64)
        for k in range(max(lengths, default=0)):
            whole = at + k < end
            if not whole.all():
                at, end, value = at[whole], end[whole], value[whole]
            value = (value ^ self.hashes[at + k]) * _U(0x9FB21C651E98DF25) + _U(k + 1)
            value ^= value >> _U(32)
            if k + 1 in lengths:
                yield k + 1, at, mix64(value)

    def digest(self, first: int, length: int) -> bytes:
        """SHA-256 of ``length`` words joined by blanks."""
        if self._flat is None:  # each word and one blank after it
            keep, flat = self._inside.copy(), self.data.copy()
            gaps = self.stops[self.stops < len(flat)]
            gaps = gaps[~keep[gaps]]
            keep[gaps], flat[gaps] = True, 32
            self._place = np.concatenate([[0], np.cumsum(keep)])
            self._flat = flat[keep].tobytes()
        a, b = self._place[self.starts[first]], self._place[self.stops[first + length - 1]]
        return hashlib.sha256(self._flat[a:b]).digest()


def _slices(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for a, b, data, offsets in text_slices(column, SLICE_BYTES):
        yield a, b, Words(data, offsets)


def _window_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("item").to_pylist()
            for a, b, words in _slices(batch.column("text")):
                owner = np.repeat(np.arange(b - a), words.counts)
                for length, at, value in words.windows(set(range(1, width + 1))):
                    fit = np.minimum(words.counts, width)[owner[at]] == length
                    at, value = at[fit], value[fit]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), length, np.int32)),
                            pa.array(value.view(np.int64)),
                            pa.array([words.digest(i, length) for i in at.tolist()], pa.binary()),
                            pa.array([items[a + i] for i in owner[at].tolist()], pa.string()),
                        ],
                        names=["length", "hash", "digest", "item"],
                    )

    return run


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (length, hash, digest, item) of all windows of ``benchmark(item_id, text)``."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(_window_batches(width), WINDOWS).distinct()


# -- one block of the hash set ------------------------------------------------------------


@dataclass
class Block:
    """What is broadcast: sorted hashes and a bit table per length, and the items of each window."""

    hashes: dict[int, np.ndarray]
    bits: dict[int, np.ndarray]
    items: dict[bytes, tuple[str, ...]]

    @staticmethod
    def of(rows: pd.DataFrame) -> Block:
        hashes, bits = {}, {}
        for length, values in rows.groupby("length")["hash"]:
            known = np.unique(values.to_numpy(np.int64).view(np.uint64))
            table = np.zeros(1 << max(10, (len(known) * 32).bit_length()), dtype=bool)
            table[known & _U(len(table) - 1)] = True
            hashes[int(length)], bits[int(length)] = known, table
        items = rows.groupby("digest")["item"].agg(tuple).to_dict() if len(rows) else {}
        return Block(hashes, bits, items)

    def hits(self, words: Words) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, length, items) of every verified window."""
        for length, at, value in words.windows(set(self.hashes)):
            bits, known = self.bits[length], self.hashes[length]
            maybe = np.flatnonzero(bits[value & _U(len(bits) - 1)])
            place = np.minimum(np.searchsorted(known, value[maybe]), len(known) - 1)
            for i in at[maybe[known[place] == value[maybe]]].tolist():
                items = self.items.get(words.digest(i, length))
                if items:
                    yield i, length, items


def _scan_batches(shared, columns: list[str], earlier: bool, cut: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            text = batch.column("__text")
            for a, b, words in _slices(text):
                part = batch.slice(a, b - a)
                change = np.zeros(len(words) + 1, np.int64)
                found: dict[int, set[str]] = {}
                if earlier:
                    for i, (spans, items) in enumerate(zip(part["hits"].to_pylist(), part["items"].to_pylist())):
                        for span in spans:
                            change[words.bounds[i] + span["start"]] += 1
                            change[words.bounds[i] + span["end"]] -= 1
                        if items:
                            found[i] = set(items)
                for first, length, items in block.hits(words):
                    change[first] += 1
                    change[first + length] -= 1
                    found.setdefault(int(np.searchsorted(words.bounds, first, side="right")) - 1, set()).update(items)
                hit = np.cumsum(change[:-1]) > 0
                texts = text.slice(a, b - a).to_pylist() if cut else [None] * (b - a)
                spans = [[] for _ in range(b - a)]
                for i in found:
                    lo, hi = words.bounds[i], words.bounds[i + 1]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:hi].view(np.int8), [0]]))).tolist()
                    spans[i] = [{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])]
                    if cut:
                        raw, kept, at = texts[i].encode(), [], 0
                        origin = int(words.origins[i])
                        for s, e in zip(edge[::2], edge[1::2]):
                            kept.append(raw[at : words.starts[lo + s] - origin])
                            at = words.stops[lo + e - 1] - origin
                        texts[i] = b"".join([*kept, raw[at:]]).decode()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[c] for c in columns),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(found.get(i, ())) for i in range(b - a)], pa.list_(pa.string())),
                        pa.array(texts, pa.string()),
                    ],
                    names=[*columns, "n_words", "hits", "items", "clean"],
                )

    return run


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[Column], width: int = WIDTH, cut: bool = False) -> DataFrame:
    """``keep`` of ``docs`` with n_words, hits (ranges of words), items and clean (the text without
    its hits, if ``cut``)."""
    spark = docs.sparkSession
    windows = materialize(benchmark_windows(benchmark, width), "op12-windows")
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    kept = [f for f in rows.schema.fields if f.name != "__text"]
    earlier = False
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("digest", "item"), F.lit(blocks)) == number
        block = Block.of(windows.where(mine).toPandas())  # about BLOCK_WINDOWS rows of fixed size
        again = number < blocks - 1
        fields = [*kept, rows.schema["__text"]] if again else kept
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), FOUND])
        run = _scan_batches(spark.sparkContext.broadcast(block), [f.name for f in fields], earlier, cut and not again)
        rows = rows.mapInArrow(run, schema)
        if again:
            rows, earlier = materialize(rows, "op12-scanned"), True
    return rows


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    Defined results: a null or wordless text has no words and no hits; an item without words has
    no window; rows that share an item_id are one item, a null item_id is the item ''; repeated rows
    come back once each; empty tables give no rows or no hits; other columns are ignored.
    """
    found = scan(docs, benchmark, [F.col("doc_id")], width)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = True, width: int = WIDTH) -> DataFrame:
    """``docs`` without contaminated documents (``whole``), or with their hit words cut out.

    All columns of ``docs`` come back, in order; texts without hits stay as they are, null
    included; a cut goes from the first to the last word of a run of hit words.
    """
    columns = docs.columns
    keep = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    found = scan(docs, benchmark, keep, width, cut=not whole)
    clean = F.when(F.size("hits") > 0, F.col("clean"))
    at = columns.index("text")
    if whole:
        found = found.where(F.size("hits") == 0)
    return found.select(
        *(
            (F.col(f"c{i}") if whole or i != at else F.coalesce(clean, F.col(f"c{i}").cast("string"))).alias(c)
            for i, c in enumerate(columns)
        )
    )


ORACLE_SQL = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, unnest(list_transform(
    range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS ngram
  FROM items WHERE len(w) > 0),
words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
scanned AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS pos, unnest(list_transform(
    range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS ngram
  FROM words, sizes),
hits AS (
  SELECT r, pos, scanned.size AS size, item FROM scanned JOIN windows ON scanned.ngram = windows.ngram AND scanned.size = windows.size),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered ON words.r = covered.r LEFT JOIN named ON words.r = named.r
"""
