"""Interaction of five document filters: what each removes at every place of every order.

A document fails some of the filters; the removal game gives a coalition S of filters the number
of documents that fail at least one of S.  The counts v(S) of all 32 coalitions say all:

* in an order, the filter after the coalition S removes v(S + i) - v(S);
* the Hart-Mas-Colell potential is P(S) = (v(S) + sum of P(S - i)) / |S|, P(none) = 0, computed
  from the small coalitions to the large ones; the Shapley value of i is P(all) - P(all - i).
  Here Q(S) = |S|! P(S) = (|S| - 1)! v(S) + sum of Q(S - i) keeps everything whole numbers, and the
  removals of i summed over all 120 orders are 120 times its Shapley value: Q(all) - 5 Q(all - i).

A text is read once, for its filters and its digest; everything after is slim rows.  Equal texts
meet as a partially aggregated minimum of ids per digest, and only the first document of each
text is joined back, by (digest, id), so a text in a third of all rows is never gathered.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize
from tidepool.llm.quality_rules import bound

FILTERS = "ABCDE"
#: The filters' limits and character classes.
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOL = "[#$%&*|]"
WORD_RUN = r"[\x20\x09-\x0D]+"

_ALL = (1 << len(FILTERS)) - 1
_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}


def _failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, WORD_RUN), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))

    def of_words(w: Column) -> Column:
        few = F.when(F.size(w) < LEAST_WORDS, _BIT["A"]).otherwise(0)
        same = F.size(F.array_distinct(w)) * 100 < F.size(w) * DISTINCT_PERCENT
        return few + F.when(same, _BIT["B"]).otherwise(0)

    return (
        bound(words, of_words)
        + F.when(capitals * 100 > F.length(text) * CAPITAL_PERCENT, _BIT["C"]).otherwise(0)
        + F.when(text.rlike(SYMBOL), _BIT["D"]).otherwise(0)
    )


def failed_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per language and set of failed filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    facts = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        _failures(text).alias("bits"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    facts = materialize(facts.groupBy("doc_id", "part", "bits", "digest").agg(F.count("*").alias("n")), "op13-facts")
    named = facts.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    again = F.when(F.col("first").isNull(), _BIT["E"]).otherwise(0)
    judged = (
        named.join(first, ["digest", "doc_id"], "left")
        .join(marks, "doc_id", "left")
        .select(
            "part",
            (F.col("bits") + again).alias("mask"),
            "n",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )
    no = F.lit(False)
    unnamed = facts.where("doc_id is null").select(
        "part", F.col("bits").alias("mask"), "n", no.alias("good"), no.alias("toxic")
    )
    return (
        judged.unionByName(unnamed)
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def _coalitions(counts: DataFrame) -> DataFrame:
    """Per part: n, and arrays over the 32 coalitions: removed, good, toxic, potential (Q)."""
    total = [F.sum("n").alias("n")]
    for of in ("n", "good", "toxic"):
        for s in range(_ALL + 1):
            hit = F.col("mask").bitwiseAND(F.lit(s)) != 0
            total.append(F.coalesce(F.sum(F.when(hit, F.col(of))), F.lit(0)).alias(f"{of}_{s}"))
    out = counts.groupBy("part").agg(*total)
    out = out.withColumn("q_0", F.lit(0).cast("long"))
    for size in range(1, len(FILTERS) + 1):
        level = {}
        for s in range(_ALL + 1):
            if s.bit_count() == size:
                less = [F.col(f"q_{s - b}") for b in _BIT.values() if s & b]
                level[f"q_{s}"] = sum(less, F.col(f"n_{s}") * factorial(size - 1))
        out = out.withColumns(level)
    arrays = {"removed": "n", "good": "good", "toxic": "toxic", "potential": "q"}
    return out.select(
        "part",
        "n",
        *(F.array(*(F.col(f"{c}_{s}") for s in range(_ALL + 1))).alias(name) for name, c in arrays.items()),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step, with the counts of that step.

    Defined results: a null text is empty; a null language is the part ''; each repeated row
    counts; a document without id fails E never, causes no failure of E and has no label; of
    repeated labels any 1 counts, null ones do not; a missing label is neither good nor toxic; an
    empty table gives an empty result; other columns are ignored.
    """
    games = _coalitions(failed_filters(docs, labels))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    rows = games.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))))
    bits = [F.when(F.instr("filter_order", c) < F.col("step"), b).otherwise(0) for c, b in _BIT.items()]
    own = F.element_at(
        F.create_map(*(F.lit(x) for pair in _BIT.items() for x in pair)),
        F.substring("filter_order", F.col("step"), F.lit(1)),
    )
    rows = rows.withColumns({"before": sum(bits, F.lit(0)), "own": own})
    after = F.col("before") + F.col("own")
    rest = F.lit(_ALL) - F.col("own")

    def gained(game: str) -> Column:
        return F.get(game, after) - F.get(game, "before")

    return rows.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("n") - F.get("removed", after)).alias("kept"),
        gained("removed").alias("removed"),
        (F.get("removed", "own") - gained("removed")).alias("redundant"),
        (F.get("removed", F.lit(_ALL)) - F.get("removed", rest)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(_ALL)) - F.get("potential", rest) * len(FILTERS)).alias("shapley"),
    )


#: The same rows by replaying every order over the masks.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT words.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         {'A': len(w) < 100,
          'B': 100 * len(list_distinct(w)) < 80 * len(w),
          'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(min(words.doc_id) OVER (PARTITION BY text) < words.doc_id, false)} AS f
  FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id),
bits AS (
  SELECT part, good, toxic,
         concat(CASE WHEN f.A THEN 'A' ELSE '' END, CASE WHEN f.B THEN 'B' ELSE '' END, CASE WHEN f.C THEN 'C' ELSE '' END,
                CASE WHEN f.D THEN 'D' ELSE '' END, CASE WHEN f.E THEN 'E' ELSE '' END) AS failed
  FROM masks),
counts AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM bits GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order
  FROM letters a, letters b, letters d, letters e, letters g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
replayed AS (
  SELECT part, filter_order, step, filter_order[step] AS own, n, good, toxic, failed,
         contains(failed, filter_order[step]) AS fails,
         len(list_filter(string_split(filter_order[1:step - 1], ''), lambda x: x <> '' AND contains(failed, x))) > 0 AS gone
  FROM counts, steps),
stepped AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE failed = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM replayed GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM stepped
"""
