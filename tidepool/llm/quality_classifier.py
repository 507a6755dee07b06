"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its features: its words and the n-grams of its
characters (lengths ``GRAMS``, separators as blanks, none beyond the text), hashed, and for each
pair of neighbouring words whether it is the same word again.  The last is beside the n-grams
because hashing gives "ba ba" and "do do" nothing in common, and repetition is what marks a part of
the bad documents (without it 28 of 136 held-out ones pass at sf0.1, with it 2).  A linear layer
with softmax turns the average into two class probabilities.  Vectors and layer are trained
together by numpy stochastic gradient descent with a linearly falling step.

The training sample is bounded: at most ``max_train`` labelled rows, those with the smallest
hash of their id.  Their feature counts (at most ``BUCKETS`` numbers a document) are computed
by the executors; the driver receives only this bounded sample and broadcasts the fitted model.
Because the output is linear in the average, scoring needs one number per feature, the
difference of the two classes' scores, so whole texts are scored at memory speed.  These numbers
are summed as integers (units of 2**-``FRACTION``), so a text's score depends on nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import held_out, mix64, row_and_text, text_of, text_slices, word_bounds, word_hashes

BUCKETS = 1 << 14
GRAMS = (2, 3, 4)
DIMENSIONS = 16
EPOCHS = 12
STEP = 0.6
MAX_TRAIN = 3000
THRESHOLD = 0.7
SLICE_BYTES = 1 << 18  # a worker holds about 100 bytes of features for each
FRACTION = 24
SHAPES = 2  # buckets of their own: another word, the same word again
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code of each character (its UTF-8 bytes; separators as blanks) and the texts' bounds."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(data)))
    code = data[first].astype(np.uint64)
    code[(code >= 9) & (code <= 13)] = 32
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        code[more] |= data[first[more] + k].astype(np.uint64) << np.uint64(8 * k)
    return code, np.searchsorted(first, offsets)


def _hashed(code: np.ndarray) -> np.ndarray:
    return (code % np.uint64(BUCKETS - SHAPES)).astype(np.int64) + SHAPES


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind of feature: the buckets over all texts, and where each text's begin and end."""

    def within(buckets: np.ndarray, first: np.ndarray, last: np.ndarray, width: int):
        """The windows of ``width`` that begin in a text and end in it."""
        begin = np.minimum(first, len(buckets))
        return buckets, begin, np.maximum(begin, last - width + 1)

    starts, stops, counts = word_bounds(data, offsets)
    ends = np.cumsum(counts)
    words = word_hashes(data, starts, stops)
    out = [within(_hashed(words), ends - counts, ends, 1)]
    out.append(within((words[1:] == words[:-1]).astype(np.int64), ends - counts, ends, 2))
    characters, bounds = _characters(data, offsets)
    code = characters
    for n in range(2, max(GRAMS) + 1):
        code = mix64(code[: max(len(characters) - n + 1, 0)] * _FOLD + characters[n - 1 :])
        if n in GRAMS:
            out.append(within(_hashed(code), bounds[:-1], bounds[1:], n))
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for a, b, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            kinds = features(data, offsets)
            ids, weights = [], []
            for k in range(b - a):
                count = np.zeros(BUCKETS, dtype=np.int64)
                for buckets, begin, end in kinds:
                    count += np.bincount(buckets[begin[k] : end[k]], minlength=BUCKETS)
                seen = np.flatnonzero(count)
                ids.append(seen.astype(np.uint16).tobytes())
                weights.append((count[seen] / max(count.sum(), 1)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[a:b], pa.int32()), pa.array(ids, pa.binary()), pa.array(weights, pa.binary())],
                names=["label", "ids", "weights"],
            )


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 11) -> tuple[np.ndarray, float]:
    """(score difference of class 1 over class 0 per bucket, the same of the bias)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    total, done = max(1, EPOCHS * len(samples)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(samples)):
            label, ids, weights = samples[k]
            step = STEP * (1 - done / total)
            done += 1
            mean = weights @ vectors[ids]
            logits = mean @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= np.float32(0.1 * step) * error
            # a document touches a bucket by its share; the step is scaled to the sparse share
            vectors[ids] -= (step * 10) * weights[:, None] * back
    difference = layer[:, 1] - layer[:, 0]
    return (vectors @ difference).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Train on at most ``max_train`` labelled rows that are not held out."""
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64(F.lit("train"), "doc_id"), "doc_id").limit(max_train)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # at most max_train rows of two numbers
    rows = rows.dropDuplicates(["doc_id"])
    # as Arrow: neither the JVM nor Python makes rows of the sample
    table = rows.select("label", "text").mapInArrow(_counts, "label int, ids binary, weights binary").toArrow()
    samples = sorted(zip(*(table.column(k).to_pylist() for k in range(3)), strict=True))
    del table
    return train([(y, np.frombuffer(i, np.uint16), np.frombuffer(w, np.float32)) for y, i, w in samples])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_bucket, bias = model.value
        units = np.rint(per_bucket.astype(np.float64) * (1 << FRACTION)).astype(np.int64)
        for batch in batches:
            scores = []
            for a, b, data, offsets in text_slices(text_of(batch), SLICE_BYTES):
                total, number = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for buckets, begin, end in features(data, offsets):
                    sums = np.concatenate([[0], np.cumsum(units[buckets])])
                    total += sums[end] - sums[begin]
                    number += end - begin
                mean = total / (np.maximum(number, 1) * float(1 << FRACTION))
                scores.append(1 / (1 + np.exp(-(mean + bias))))
            keep = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*names, "score"]
            )

    return run


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text, ...)``.

    Only the text is scored.  Defined results: null and empty texts get the score of the bias;
    repeated rows come back once each; without labelled rows every score is 0.5; a doc_id with
    several labels has the larger one; null labels and other values than 0 and 1 are ignored;
    an empty table gives an empty result; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    rows = docs.select(
        "doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    kind = dict(docs.dtypes)["doc_id"]
    scored = rows.mapInArrow(_score(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns.

    Every row is judged by its own text, so rows without id and rows that share an id with
    another text have a verdict of their own; no join.  An empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    rows = docs.select(*row_and_text(docs))
    schema = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_score(model), schema).where(F.col("score") >= THRESHOLD).select("doc.*")
