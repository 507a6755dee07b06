"""Quality rules by robust multivariate outliers, in DataFrame operations only.

Every text gets counts (words, characters, symbols, repeated lines and words, capitals), and
these a transformed statistic vector.  Per language and source, a minimum-covariance-determinant
estimate of its centre and scatter is found by concentration steps from two deterministic
starts: keep the ``COVER`` share with the smallest Mahalanobis distances, recompute mean and
covariance, repeat.  The start with the smaller determinant wins.  A document whose distance
exceeds ``CUTOFF`` is rejected.

Each step is one partially aggregated group-by of moments and one of quantile sketches, so a
source with a third of all rows is summed map-side; estimates stay a table with one row per
group and are joined back.  Scatter gets a floor per statistic (``FLOOR``): several statistics
are zero in most clean texts, and a deviation below the floor is never evidence.

The same estimate is found for every language and for all documents, and a group's estimate is
combined with its language's, and that with the one of all, as in a conjugate update: the wider
one counts as ``PRIOR`` documents.  A group of a few documents so has nearly its language's
estimate and one of thousands its own, by one rule at every size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize

WORD_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = ("word_length", "symbols", "lines", "repeats", "capitals")
#: Standard deviations that the scatter has at least, per statistic.
FLOOR = (0.08, 0.06, 0.15, 0.10, 0.06)
COVER = 0.75
STEPS = 4
#: Documents that the wider estimate counts as.
PRIOR = 40.0
SPREAD = 32
#: Stands for all sources of a language, and for all languages.
ALL = "*"
#: Squared distance: the chi-square quantile of 5 degrees of freedom at 0.999.
CUTOFF = 20.5
#: Consistency of the covariance of the nearest 75 % for normal data in 5 dimensions.
CONSISTENCY = 1.41


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text, first ones included."""

    def windows(w: Column) -> Column:
        every = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(every, 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def repeated(h: Column) -> Column:
        def marked(s: Column) -> Column:
            again = F.transform(
                s,
                lambda x, i: F.when(
                    (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["p"]
                ),
            )
            return F.sort_array(F.filter(again, lambda x: x.isNotNull()))

        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        return bound(bound(F.sort_array(placed), marked), covered)

    return bound(
        bound(words, windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)),
    )


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of every whole text; a null text has none of anything."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("__text"))
    words = F.filter(F.split("__text", WORD_RUN), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    removed = lambda chars: F.length("__text") - F.length(F.translate("__text", chars, ""))
    counts = bound(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    line_counts = bound(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return rows.select(
        *keep,
        counts.alias("__w"),
        line_counts.alias("__l"),
        removed(SYMBOLS).cast("long").alias("n_symbols"),
        removed(CAPITALS).cast("long").alias("n_capitals"),
    ).select(*keep, "__w.*", "__l.*", "n_symbols", "n_capitals")


def _vector() -> list[Column]:
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return [
        F.log1p(per("word_chars", "n_words")),
        F.sqrt(per("n_symbols", "word_chars")),
        per("n_dup_lines", "n_lines"),
        per("n_repeat_words", "n_words"),
        F.sqrt(per("n_capitals", "word_chars")),
    ]


def _squared_distance(columns: list[Column], prefix: str = "") -> Column:
    """Mahalanobis distance from centre m<i> and lower Cholesky factor l<i>_<j>, by forward
    substitution; the partial solutions are bound one after the other."""

    def solve(i: int, done: list[Column]) -> Column:
        if i == len(columns):
            return reduce(lambda a, b: a + b, [z * z for z in done])
        rest = columns[i] - F.col(f"{prefix}m{i}")
        for j, z in enumerate(done):
            rest = rest - F.col(f"{prefix}l{i}_{j}") * z
        return bound(rest / F.col(f"{prefix}l{i}_{i}"), lambda z: solve(i + 1, [*done, z]))

    return solve(0, [])


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Row count n, mean m<i> and covariance s<i>_<j> (made consistent) of every group."""
    p = len(STATISTICS)
    x = [F.col(f"x{i}") for i in range(p)]
    sums = [F.count("*").alias("n")]
    sums += [F.avg(x[i]).alias(f"m{i}") for i in range(p)]
    sums += [F.avg(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i + 1)]
    spread = [
        ((F.col(f"q{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY).alias(f"s{i}_{j}")
        for i in range(p)
        for j in range(i + 1)
    ]
    return rows.groupBy(*keys).agg(*sums).select(*keys, "n", *(f"m{i}" for i in range(p)), *spread)


def _factored(table: DataFrame) -> DataFrame:
    """``table`` with the Cholesky factor l<i>_<j> of its floored covariance and the factor's
    log-determinant, size."""
    p = len(STATISTICS)
    out = table
    for i in range(p):
        for j in range(i + 1):
            value = F.col(f"s{i}_{j}")
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOOR[i] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(FLOOR[i] ** 2 / 4)))
            else:
                value = value / F.col(f"l{j}_{j}")
            out = out.withColumn(f"l{i}_{j}", value)
    return out.withColumn("size", sum((F.log(f"l{i}_{i}") for i in range(p)), F.lit(0.0)))


def _combined(own: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of ``own`` after ``wider``, whose rows ``keys`` select, counted as ``PRIOR`` documents.

    The mean and covariance of both together, the distance of their means included (the update of
    a normal-inverse-Wishart prior).  Both have one row per group.
    """
    p = len(STATISTICS)
    names = [f"m{i}" for i in range(p)] + [f"s{i}_{j}" for i in range(p) for j in range(i + 1)]
    wide = wider.select(*keys, *(F.col(c).alias(f"w_{c}") for c in names))
    share = F.col("n") / (F.col("n") + PRIOR)
    apart = [F.col(f"m{i}") - F.col(f"w_m{i}") for i in range(p)]
    mixed = {c: share * F.col(c) + (1 - share) * F.col(f"w_{c}") for c in names}
    for i in range(p):
        for j in range(i + 1):
            mixed[f"s{i}_{j}"] = mixed[f"s{i}_{j}"] + share * (1 - share) * apart[i] * apart[j]
    kept = [c for c in own.columns if c not in names]
    return own.join(wide, keys).select(*kept, *(mixed[c].alias(c) for c in names))


def _spread_join(rows: DataFrame, per_group: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with one row per group; each group's rows go to ``SPREAD`` places.

    The row of a group is repeated ``SPREAD`` times, so a group with a third of all rows meets
    it in many tasks, and what is grouped afterwards is summed map-side first.
    """
    salted = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
    copies = per_group.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def _estimates(vectors: DataFrame) -> DataFrame:
    """Moments (n, m<i>, s<i>_<j>) of the winning subset of every group of ``vectors(g1, g2, x0..)``."""
    p = len(STATISTICS)
    keys = ["g1", "g2"]
    x = [F.col(f"x{i}") for i in range(p)]
    middle = vectors.groupBy(*keys).agg(
        *(F.percentile_approx(x[i], 0.5, 1000).alias(f"c{i}") for i in range(p))
    )
    around = _spread_join(vectors, middle, keys)
    spread = around.groupBy(*keys).agg(
        *(F.percentile_approx(F.abs(x[i] - F.col(f"c{i}")), 0.5, 1000).alias(f"d{i}") for i in range(p))
    )
    scaled = sum(
        (
            F.pow((x[i] - F.col(f"c{i}")) / F.greatest(F.col(f"d{i}") * 1.4826, F.lit(FLOOR[i])), 2)
            for i in range(p)
        ),
        F.lit(0.0),
    )
    plain = sum((F.abs(x[i] - F.col(f"c{i}")) / FLOOR[i] for i in range(p)), F.lit(0.0))
    starts = F.array(
        F.struct(F.lit(0).alias("start"), scaled.alias("d2")),
        F.struct(F.lit(1).alias("start"), plain.alias("d2")),
    )
    now = _spread_join(around, spread, keys).select(*keys, *x, F.explode(starts).alias("s"))
    now = now.select(*keys, *x, "s.start", "s.d2")
    keyed = [*keys, "start"]
    both = vectors.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    for _ in range(STEPS):
        now = materialize(now, "op6-step")
        limit = now.groupBy(*keyed).agg(F.percentile_approx("d2", COVER, 1000).alias("limit"))
        near = _spread_join(now, limit, keyed).where("d2 <= limit")
        estimate = materialize(_factored(_moments(near, keyed)), "op6-scatter")
        now = _spread_join(both, estimate, keyed).select(*keyed, *x, _squared_distance(x).alias("d2"))
    best = estimate.groupBy(*keys).agg(F.min(F.struct("size", "start")).alias("best"))
    found = estimate.join(best, keys).where("start = best.start")
    return found.select(*keys, "n", *(c for c in found.columns if c[0] in "ms" and c[1].isdigit()))


def _levels(vectors: DataFrame) -> DataFrame:
    """Every vector in its group, in its language and among all."""
    levels = [(F.col("g1"), F.col("g2")), (F.col("g1"), F.lit(ALL)), (F.lit(ALL), F.lit(ALL))]
    groups = F.array(*(F.struct(a.alias("g1"), b.alias("g2")) for a, b in levels))
    rest = [c for c in vectors.columns if c not in ("g1", "g2")]
    return vectors.select(F.explode(groups).alias("g"), *rest).select("g.*", *rest)


def _group_estimates(vectors: DataFrame) -> DataFrame:
    """Centre m<i> and Cholesky factor l<i>_<j> of every group, combined with the wider estimates."""
    found = materialize(_estimates(materialize(_levels(vectors), "op6-vectors")), "op6-estimates")
    top = found.where((F.col("g1") == ALL) & (F.col("g2") == ALL)).withColumnRenamed("g1", "top")
    languages = found.where((F.col("g1") != ALL) & (F.col("g2") == ALL)).withColumn("top", F.lit(ALL))
    languages = _combined(languages, top.drop("g2"), ["top"])
    groups = _combined(found.where(F.col("g2") != ALL), languages, ["g1"])
    factored = materialize(_factored(groups), "op6-factors")
    return factored.select("g1", "g2", *(c for c in factored.columns if c[0] in "ml" and c[1].isdigit()))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    distance2) for every row of ``docs(doc_id, text, lang, source, ...)``.

    Defined results: a null or empty text has zero counts and fails the base rules; null
    languages and sources are groups of their own; repeated rows come back once each; equal
    distances share a verdict; distance2 is null where the base rules fail; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g1"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("g2"),
    )
    counted = text_counts(rows, ["doc_id", "g1", "g2"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed).withColumn("v", F.array(*_vector()))
    counted = materialize(counted, "op6-counts")
    x = [F.get("v", i) for i in range(len(STATISTICS))]
    vectors = counted.where("not base_failed").select(
        "g1", "g2", *(c.alias(f"x{i}") for i, c in enumerate(x))
    )
    out = _spread_join(counted, _group_estimates(vectors), ["g1", "g2"], "left")
    distance = F.when(~F.col("base_failed"), _squared_distance(x))
    out = out.withColumn("distance2", distance)
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance2") <= CUTOFF, F.lit(True))).alias("kept"),
        "distance2",
    )
