"""Target-distribution importance resampling over hashed word features.

Features of a text are its words and pairs of neighbouring words; each falls into one of
``BUCKETS`` buckets by CRC-32.  A bucket's gain is the log-ratio of its smoothed shares in the
target texts and in the corpus; a document weighs the mean gain of its features, and Gumbel noise
from its id turns the highest scores into a weighted draw without replacement.

A batch's texts are joined with a separator between them; one regular-expression pass finds all
words, ``searchsorted`` on the texts' offsets tells whose they are, and pairs across a border are
masked before ``bincount``.  The CRC of a pair follows from those of its words: appending bytes is
a linear map of the register, composed here from maps for powers of two of lengths.

Two passes read the texts (corpus counts, then weights); each keeps ``BUCKETS`` sums a task, and
10,000 totals reach the driver, whatever the corpus.  Only slim rows are sorted for the ranks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, with_global_rank

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
SEPARATOR = b"\0"
BATCH_BYTES = 1 << 20
KNOWN_WORDS = 1 << 18

#: Words of lower-cased UTF-8: digits, letters and everything beyond ASCII (fixed by the contract).
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_POLYNOMIAL = 0xEDB88320


# -- CRC-32 of two words from those of each -----------------------------------------------


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


def _advance(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & 255]
    for k in range(1, 4):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 255]
    return out


def _zero_maps(most: int = 32) -> list[np.ndarray]:
    """Maps of the register over 2**k zero bytes, as tables for each of its bytes."""
    one = _byte_table()
    low = np.arange(256, dtype=np.uint32)
    shifted = [low << np.uint32(8 * k) for k in range(4)]
    maps = [np.stack([(v >> np.uint32(8)) ^ one[v & 255] for v in shifted])]
    while len(maps) < most:
        last = maps[-1]
        maps.append(np.stack([_advance(last, last[k]) for k in range(4)]))
    return maps


_ZEROS = _zero_maps()


def joined_crc(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings put together, from their own and the length of the second."""
    out = left.copy()
    k = 0
    while (right_bytes >> k).any():
        on = np.flatnonzero((right_bytes >> k) & 1)
        out[on] = _advance(_ZEROS[k], out[on])
        k += 1
    return out ^ right


# -- features of a batch ------------------------------------------------------------------


class Features:
    """Buckets of all features of joined texts; words met before are looked up."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.crc = self.spaced = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)

    def _codes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.__init__()
        known = self.known
        codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        if len(known) > len(self.crc):
            new = list(known)[len(self.crc) :]
            blank = zlib.crc32(b" ")
            self.crc = np.append(self.crc, np.array([zlib.crc32(w) for w in new], np.uint32))
            self.spaced = np.append(self.spaced, np.array([zlib.crc32(w, blank) for w in new], np.uint32))
            self.size = np.append(self.size, np.array([len(w) for w in new], np.int64))
        return codes

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets of all features, the text of each, words per text)."""
        offsets = np.cumsum([0, *(len(t) + len(SEPARATOR) for t in texts)])
        found = list(_WORD.finditer(SEPARATOR.join(texts).lower()))
        starts = np.fromiter((m.start() for m in found), np.int64, len(found))
        owner = np.searchsorted(offsets, starts, side="right") - 1
        code = self._codes([m.group() for m in found])
        words = (self.crc[code] % BUCKETS).astype(np.int64)
        whole = np.flatnonzero(owner[1:] == owner[:-1])
        second = code[1:][whole]
        pairs = joined_crc(self.crc[code[:-1][whole]], self.spaced[second], self.size[second] + 1)
        buckets = np.concatenate([words, (pairs % BUCKETS).astype(np.int64)])
        return buckets, np.concatenate([owner, owner[whole]]), np.bincount(owner, minlength=len(texts))


def _parts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, whole texts) of runs of about ``BATCH_BYTES``; a null text is empty."""
    start, size, texts = 0, 0, []
    for i, text in enumerate(column.cast(pa.large_binary())):
        if texts and size > BATCH_BYTES:
            yield start, texts
            start, size, texts = i, 0, []
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
    if texts:
        yield start, texts


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, total = Features(), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, texts in _parts(batch.column("text")):
            total += np.bincount(features.of(texts)[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts per bucket; only the ``BUCKETS`` totals come to the driver."""
    counts = texts.select(F.col("text").cast("string").alias("text"))
    counts = counts.mapInArrow(_count_batches, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of smoothed shares, floored, per bucket."""
    up = (target + 1.0) * (float(corpus.sum()) + BUCKETS)
    down = (corpus + 1.0) * (float(target.sum()) + BUCKETS)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weigh(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, features = shared.value, Features()
        for batch in batches:
            for start, texts in _parts(batch.column("text")):
                buckets, owner, words = features.of(texts)
                n = np.bincount(owner, minlength=len(texts))
                total = np.bincount(owner, gain[buckets], len(texts)).astype(np.int64)  # exact below 2**53
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, len(texts)),
                        pa.array(words),
                        pa.array(n),
                        pa.array(total // np.maximum(n, 1)),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs(doc_id, text, ...)``.

    ``percent`` of the documents with ``least_words`` words are drawn, by descending score, then by
    ascending doc_id; ``rank`` is null for the others.  Defined results: a null or wordless text
    has no features and weight 0; a null doc_id has the noise of an empty one and comes last among
    ties; repeated rows are documents of their own (equal rows in any order); without target texts
    all gains come from the corpus alone; an empty table gives an empty result; other columns are
    ignored.
    """
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(target), bucket_counts(base))
    kind = base.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers
    weighed = base.mapInArrow(_weigh(shared), f"doc_id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")
    scored = weighed.withColumns({"score": F.col("weight") + noise, "__row": F.monotonically_increasing_id()})
    scored = materialize(scored, "op11-scored")
    able = scored.where(F.col("n_words") >= least_words)
    take = percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("__row")]
    ranked = with_global_rank(able, order, "op11-ranked", "__rank")
    rank = F.when(F.col("__rank") < take, F.col("__rank") + 1)
    rest = scored.where(F.col("n_words") < least_words).withColumn("__rank", F.lit(None).cast("long"))
    out = ranked.unionByName(rest)
    return out.select(
        F.col("doc_id"), F.col("n_features"), F.col("weight"), F.col("score"), rank.cast("long").alias("rank")
    )


#: CRC-32 byte by byte over the distinct features; everything else plain SQL.
ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    list_prepend(b::BIGINT, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
texts AS (
  SELECT 'd' AS kind, doc_id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT kind, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS (
  SELECT kind, doc_id, unnest(w) AS f FROM words
  UNION ALL
  SELECT kind, doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) % 10000 AS bucket
  FROM hexed, crc_table),
placed AS (SELECT kind, doc_id, bucket FROM features JOIN hashed USING (f)),
totals AS (
  SELECT bucket, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 'b') AS t
  FROM placed GROUP BY bucket),
sums AS (SELECT sum(s)::DOUBLE AS total_s, sum(t)::DOUBLE AS total_t FROM totals),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (total_s + 10000) / ((s + 1)::DOUBLE * (total_t + 10000))))::BIGINT AS g
  FROM totals, sums),
weights AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM placed JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || words.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights ON words.doc_id = weights.doc_id WHERE kind = 'd'),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked ON scored.doc_id = ranked.doc_id
"""
