"""Language identification as inference of a multilingual mixture.

Training counts byte trigrams of lower-cased words per language over all training rows.  Each
word of a text then has a likelihood under every language, the product over its trigrams.
Expectation-maximisation estimates the language proportions of every document from its words'
likelihoods.  The set of languages is chosen among the nested sets of the largest proportions:
each is fitted by EM, and the set with the best log-likelihood less ``PENALTY`` * log(words) per
language wins.  Sets grow until the penalty outweighs all that any set could still gain.  The
predicted language is the one with the largest proportion in the chosen set; its proportion is
the score, and the whole set comes with its proportions.

The model is a table of ``GRAMS`` x languages numbers (at most ``MAX_LANGUAGES`` languages,
more raise an error before anything is collected), summed by Spark and broadcast.  Documents are independent: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import _LOWER, held_out, mix64, row_and_text, text_of, text_slices, word_bounds

GRAMS = 1 << 15
MAX_LANGUAGES = 256
ROUNDS = 8
PENALTY = 2.0
SLICE_BYTES = 1 << 18  # a worker holds about 100 bytes of trigrams for each
UNDETERMINED = "und"
SET = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def word_grams(data: np.ndarray, offsets: np.ndarray):
    """Trigram buckets of all words, the first trigram of each word, words per text.

    A word is framed by one blank on either side: a word of n bytes has n trigrams
    (two for one byte: the frame counts).
    """
    data = _LOWER[data]
    starts, stops, counts = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), starts, counts
    size = stops - starts
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    word = np.repeat(np.arange(len(starts)), size)
    at = np.arange(int(size.sum())) - first[word] + starts[word]
    mid = data[at].astype(np.uint64)
    left = np.full(len(at), 32, dtype=np.uint64)
    left[1:] = mid[:-1]
    left[first] = 32
    right = np.full(len(at), 32, dtype=np.uint64)
    right[:-1] = mid[1:]
    right[first + size - 1] = 32
    code = (left << np.uint64(16)) | (mid << np.uint64(8)) | right
    return (mix64(code) & np.uint64(GRAMS - 1)).astype(np.int64), first, counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), dtype=object)
        for a, b, data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            grams, first, counts = word_grams(data, offsets)
            ends = np.concatenate([first, [len(grams)]])[np.concatenate([[0], np.cumsum(counts)])]
            for k in range(b - a):
                if ends[k + 1] > ends[k]:
                    own = np.bincount(grams[ends[k] : ends[k + 1]], minlength=GRAMS)
                    if languages[a + k] in totals:
                        totals[languages[a + k]] += own
                    else:
                        totals[languages[a + k]] = own
                else:
                    totals.setdefault(languages[a + k], np.zeros(GRAMS, np.int64))
    for language, count in totals.items():
        seen = np.flatnonzero(count)
        if not len(seen):
            seen = np.array([0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(seen)), pa.array(seen), pa.array(count[seen])],
            names=["lang", "gram", "n"],
        )


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probabilities (``GRAMS`` x languages) of their trigrams."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    many = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if many > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages, which the model holds")
    counted = rows.mapInArrow(_count, "lang string, gram long, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique().tolist())
    counts = np.zeros((GRAMS, max(1, len(languages))))
    code = {name: k for k, name in enumerate(languages)}
    counts[table["gram"].to_numpy(dtype=np.int64), [code[x] for x in table["lang"]]] = table["n"]
    smooth = counts + 0.05
    return languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def mixtures(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) of the chosen sets from word log-likelihoods (words x languages).

    Languages outside the set have 0, as has all of a text without words.
    """
    n = words.shape[1]
    out = np.zeros((len(counts), n))
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    total = counts[full].astype(np.float64)
    owner = np.repeat(np.arange(len(full)), counts[full])
    like = np.exp(words - words.max(axis=1)[:, None])

    def expect(texts: np.ndarray, mix: np.ndarray, rounds: int):
        """Mix and log-likelihood after EM of some texts, and a bound of that of any mix."""
        all_texts = len(texts) == len(full)
        own = like if all_texts else like[np.isin(owner, texts)]
        size = counts[full][texts]
        at, who = np.cumsum(size) - size, np.repeat(np.arange(len(texts)), size)
        for k in range(rounds):
            part = own * mix[who].astype(np.float32)
            norm = np.maximum(part.sum(axis=1), 1e-30)
            if k == rounds - 1:
                fit = np.add.reduceat(np.log(norm), at, dtype=np.float64)
                gain = np.add.reduceat(own / norm[:, None], at, axis=0, dtype=np.float64) / size[:, None]
            part /= norm[:, None]
            mix = np.add.reduceat(part, at, axis=0, dtype=np.float64) / size[:, None]
        return mix, fit, fit + size * np.log(np.maximum(gain.max(axis=1), 1.0))

    everyone = np.arange(len(full))
    mixed, _, most = expect(everyone, np.full((len(full), n), 1.0 / n), ROUNDS)
    rank = np.argsort(-mixed, axis=1, kind="stable")
    chosen, value = mixed.copy(), np.full(len(full), -np.inf)
    price = PENALTY * np.log(total + 1)
    for size in range(1, n + 1):
        texts = np.flatnonzero(most - size * price > value)
        if not len(texts):
            break
        mask = np.zeros((len(texts), n))
        np.put_along_axis(mask, rank[texts, :size], 1.0, axis=1)
        start = np.where(mask > 0, np.maximum(mixed[texts], 1e-6), 0)
        start /= start.sum(axis=1, keepdims=True)
        mix, fit, _ = expect(texts, start, 1 if size == 1 else ROUNDS // 2)
        score = fit - size * price[texts]
        better = score > value[texts]
        value[texts[better]] = score[better]
        chosen[texts[better]] = mix[better]
    out[full] = chosen
    return out


def proportions(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best language per text, its proportion) from word log-likelihoods (words x languages)."""
    mixed = mixtures(words, counts)
    return mixed.argmax(axis=1), mixed.max(axis=1)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, table = model.value
        slice_bytes = max(1 << 16, SLICE_BYTES * 4 // max(4, len(languages)))
        for batch in batches:
            letters = batch.column("letters").to_pylist()
            names, shares, sets = [], [], []
            for a, b, data, offsets in text_slices(text_of(batch), slice_bytes):
                grams, first, counts = word_grams(data, offsets)
                if languages and len(first):
                    words = np.add.reduceat(table[grams], first, axis=0)
                    mixed = mixtures(words, counts)
                else:
                    mixed = np.zeros((b - a, max(1, len(languages))))
                best, share = mixed.argmax(axis=1), mixed.max(axis=1)
                for k in range(b - a):
                    known = languages and letters[a + k]
                    names.append(languages[best[k]] if known else UNDETERMINED)
                    shares.append(min(1.0, float(share[k])) if known else 0.0)
                    order = np.argsort(-mixed[k], kind="stable")[: np.count_nonzero(mixed[k])] if known else []
                    sets.append([{"lang": languages[m], "share": min(1.0, float(mixed[k, m]))} for m in order])
            keep = [n for n in batch.schema.names if n not in ("text", "letters")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(sets, SET)],
                names=[*keep, "lang_pred", "score", "languages"],
            )

    return run


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) for every row of ``docs(doc_id, text, lang, ...)``.

    Learns from the text and non-null lang of rows that are not held out; predicts from the
    text alone; languages is the chosen set with its proportions, the largest first.  Defined
    results: ``und`` with score 0 and no languages if the text is null or has no letter, or
    if there is nothing to learn from; ties go to the language first in alphabetical order;
    repeated rows come back once each; an empty table gives an empty result; other columns are
    ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        held_out().alias("held_out"),
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(
        _predict(model),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
        "languages array<struct<lang:string,share:double>>",
    )


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have a language, with all their columns.

    Every row is judged by its own text, so rows without id and rows that share an id with
    another text have a verdict of their own; no join.  An empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    text = F.col("text").cast("string")
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*row_and_text(docs), letters.alias("letters"))
    schema = T.StructType.fromDDL(
        "lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    )
    schema = T.StructType([rows.schema["doc"], *schema.fields])
    named = rows.mapInArrow(_predict(model), schema)
    return named.where(F.col("lang_pred") != UNDETERMINED).select("doc.*")
