"""Personal data: fixed patterns, and information-theoretic sanitisation of revealing terms.

Emails, IP addresses, card and phone numbers are found by patterns; their values are the
protected entities.  How strongly a term reveals an entity is estimated from the corpus:

* equal texts are one text in every count, so that copies weigh nothing anywhere;
* a text's terms are its words without those that touch a protected value, wherever they stand;
* n(e) is the number of texts with e, n(e, t) that of the texts with e and t, n(t) that of the
  texts with t, and N that of all texts;
* an entity's *context* in a text is what stands within ``REACH`` characters around its
  occurrences there (so near copies of a document are one context);
* the information that t gives about e is log2(P(e|t) / P(e)) bits, with
  P(e|t) = n(e, t) / n(t) and P(e) = n(e) / N; divided by e's own information
  -log2 P(e) it is the *disclosure* of e by t: 1 means that t gives e away.

Terms with a disclosure of ``GENERALISE`` or more in at least ``SUPPORT`` different contexts are spans of
kind ``term`` wherever they occur; ``sanitise`` puts a class in their place (a name, a number, a
term), and removes those of ``REMOVE`` or more.

Everything is DataFrame expressions.  Positions come from splitting a text by the pattern: the
k-th match starts after k + 1 parts and k matches; the running sums go block by block.
Counts are partially aggregated, so an entity or term in a third of all rows is summed map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import column, materialize
from tidepool.llm.quality_rules import bound

REACH = 100
GLUE = "\0"  # stands for a protected value in its text
BLOCK = 512
SUPPORT = 3
GENERALISE = 0.9
REMOVE = 0.99
BROADCAST_BYTES = 32 << 20
_LOCAL = "[A-Za-z0-9._%+-]"
#: The contract's patterns.  Possessive repeats and the look-behinds change no match: a match
#: that could start inside a run of local or digit characters also starts at the run's begin.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
SPAN = "array<struct<start:int,end:int,value:string>>"


# -- expressions --------------------------------------------------------------------------


def running(values: Column, combine) -> Column:
    """Inclusive running combination (from 0) of a non-empty array of ints.

    Two levels, blocks of ``BLOCK`` items and items of a block, keep the appended arrays short.
    """

    def append(acc: Column, x: Column) -> Column:
        return F.array_append(acc, combine(F.element_at(acc, -1), x))

    def all_blocks(w: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(w) - 1) / BLOCK).cast("int"))
        block = lambda b: F.slice(w, b * BLOCK + 1, F.lit(BLOCK))
        totals = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), combine))
        return bound(
            F.aggregate(totals, F.array(F.lit(0)), append),
            lambda before: F.flatten(
                F.transform(
                    blocks,
                    lambda b: F.slice(
                        F.aggregate(block(b), F.array(F.get(before, b)), append), 2, BLOCK
                    ),
                )
            ),
        )

    return bound(values, all_blocks)


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the pattern's matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)

    def place(m: Column) -> Column:
        def starts(p: Column) -> Column:
            widths = F.transform(
                m, lambda x, i: F.length(F.get(p, i)) + F.coalesce(F.length(F.get(m, i - 1)), F.lit(0))
            )
            return bound(
                running_sums(widths),
                lambda s: F.transform(
                    m,
                    lambda x, i: F.struct(
                        F.get(s, i).alias("start"),
                        (F.get(s, i) + F.length(x)).alias("end"),
                        x.alias("value"),
                    ),
                ),
            )

        return F.when(F.size(m) == 0, F.array().cast(SPAN)).otherwise(bound(parts, starts))

    return bound(found, place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    backwards = F.split(F.reverse(digits), "")
    weighted = F.transform(
        F.filter(backwards, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(weighted, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return bound(
            _digits(value),
            lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)),
        )
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _valid_span(kind: str):
    return lambda s: _valid(kind, s["value"])


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add one array column of spans per kind (named by the kind) to ``docs``."""
    none = F.array().cast(SPAN)
    out = docs.withColumn("__t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    needs = {
        "email": F.contains(F.col("__t"), F.lit("@")),
        "ip": F.col("__t").rlike(r"[0-9]\.[0-9]"),
        "card": F.col("__t").rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
        "phone": F.col("__t").rlike(r"\+[0-9]"),
    }
    for kind, pattern in PATTERNS.items():
        spans = F.filter(matches(F.col("__t"), pattern), _valid_span(kind))
        out = out.withColumn(kind, F.when(needs[kind], spans).otherwise(none))
    return out.drop("__t")


def _term(word: Column) -> Column:
    """A word without punctuation at its ends, lower-cased."""
    return F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def _terms(words: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(words, _term), lambda t: F.length(t) > 1))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


# -- corpus statistics --------------------------------------------------------------------


def _contexts(spanned: DataFrame) -> DataFrame:
    """(entity, key, context): what stands around an entity in a text, once a text."""
    rows = None
    for kind in KINDS:
        value = F.col("s.value")
        name = F.lower(value) if kind in ("email", "ip") else _digits(value)
        one = spanned.where(F.size(kind) > 0).select(
            "__text", "__key", F.explode(kind).alias("s")
        ).select(
            "__key",
            F.concat(F.lit(f"{kind}:"), name).alias("entity"),
            F.substring(
                "__text", F.greatest(F.col("s.start") - REACH, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(REACH))
            ).alias("left"),
            F.substring("__text", F.col("s.end") + 1, F.lit(REACH)).alias("right"),
            (F.col("s.start") > REACH).alias("cut_left"),
            (F.length("__text") > F.col("s.end") + REACH).alias("cut_right"),
        )
        rows = one if rows is None else rows.unionByName(one)
    # words glued to the entity, or cut by the reach, are no part of the context
    left = F.regexp_replace("left", r"[^\x20\x09-\x0D]+$", "")
    left = F.when(F.col("cut_left"), F.regexp_replace(left, r"^[^\x20\x09-\x0D]+", "")).otherwise(left)
    right = F.regexp_replace("right", r"^[^\x20\x09-\x0D]+", "")
    right = F.when(F.col("cut_right"), F.regexp_replace(right, r"[^\x20\x09-\x0D]+$", "")).otherwise(right)
    rows = rows.select("entity", F.col("__key").alias("key"), F.xxhash64(left, right).alias("context"))
    return rows.groupBy("entity", "key").agg(
        F.xxhash64(F.sort_array(F.collect_set("context"))).alias("context")
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with the masks of all spans (start, end, mask) that start past all earlier ones."""

    def build(before: Column) -> Column:
        pieces = F.transform(
            spans,
            lambda s, i: F.when(
                s["start"] >= F.get(before, i),
                F.concat(F.substring(text, F.get(before, i) + 1, s["start"] - F.get(before, i)), s["mask"]),
            ).otherwise(""),
        )
        tail = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    reached = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    ends = bound(reached, lambda e: F.transform(e, lambda x, i: F.coalesce(F.get(e, i - 1), F.lit(0))))
    return bound(ends, build)


def _bare_terms(spanned: DataFrame) -> DataFrame:
    """Distinct (key, term) of texts with protected values, without the words that touch one."""
    named = F.concat(*(
        F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(GLUE).alias("mask")))
        for k in KINDS
    ))
    bare = bound(F.sort_array(named), lambda spans: masked(F.translate("__text", GLUE, "\1"), spans))
    words = F.filter(_words(bare), lambda w: ~F.contains(w, F.lit(GLUE)))
    return spanned.select(F.col("__key").alias("key"), F.explode(_terms(words)).alias("term")).distinct()


def _broadcast_if_small(table: DataFrame, size: Column) -> DataFrame:
    """``table``, to be broadcast if all its rows hold ``BROADCAST_BYTES`` at most; else Spark
    shuffles it to its join.  ``size``: bytes of a row."""
    held = table.agg(F.sum(size + 32).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(table) if held <= BROADCAST_BYTES else table


def _candidates(spanned: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (entity, n_e, term, n_et) that may disclose, and the terms (key, term) they come from.

    A term stands in at least as many texts as it does among those with protected values, so
    pairs whose share of these is too small already cannot reach ``GENERALISE``: common words go
    here, before anything is counted over the whole corpus.
    """
    mentions = materialize(_contexts(spanned), "op10-contexts")
    entities = (
        mentions.groupBy("entity", "context")
        .agg(F.count("*").alias("n"))
        .groupBy("entity")
        .agg(F.sum("n").alias("n_e"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= SUPPORT)
        .select("entity", "n_e")
    )
    held = materialize(mentions.join(entities, "entity"), "op10-held")
    bare = materialize(_bare_terms(spanned), "op10-bare")
    least = bare.groupBy("term").agg(F.count("*").alias("n_b")).where(F.col("n_b") >= SUPPORT)
    pairs = (
        held.join(bare, "key")
        .groupBy("entity", "n_e", "term", "context")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "n_e", "term")
        .agg(F.sum("n").alias("n_et"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= SUPPORT)
        .drop("contexts")
        .join(least, "term")
        .where(_disclosure(F.col("n_b"), total) >= GENERALISE - 1e-9)
        .drop("n_b")
    )
    return materialize(pairs, "op10-pairs"), bare


def _disclosure(n_t: Column, total: int) -> Column:
    prior = F.col("n_e") / F.lit(float(max(total, 1)))
    given = F.least(F.lit(1.0), F.col("n_et") / n_t)
    own = F.greatest(-F.log2(prior), F.lit(1.0))
    return 1 + F.log2(given) / own


def revealing_terms(texts: DataFrame, spanned: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(term, disclosure): the largest disclosure of any entity by each revealing term, and
    (key, term): where candidates occur in ``texts(__text, __key)``; None without candidates.

    The words of all texts are compared with the candidates where they are read, so what is
    shuffled is the candidates' occurrences, once a distinct text.
    """
    total = texts.select("__key").distinct().count()
    pairs, bare = _candidates(spanned, total)
    if pairs.isEmpty():
        return None
    wanted = _broadcast_if_small(pairs.select("term").distinct(), F.octet_length("term"))

    def occurrences(rows: DataFrame) -> DataFrame:
        words = rows.select(F.col("__key").alias("key"), F.explode(_terms(_words(F.col("__text")))).alias("term"))
        return words.join(wanted, "term", "left_semi").distinct()

    whole = materialize(occurrences(texts), "op10-found")
    # n(t): the texts with t, those where t only touches a protected value taken off
    rows = None
    for part, sign in ((whole, 1), (occurrences(spanned), -1), (bare.join(wanted, "term", "left_semi"), 1)):
        part = part.groupBy("term").agg((F.count("*") * sign).alias("n"))
        rows = part if rows is None else rows.unionByName(part)
    frequency = rows.groupBy("term").agg(F.sum("n").alias("n_t"))
    terms = (
        pairs.join(frequency, "term")
        .withColumn("disclosure", _disclosure(F.col("n_t"), total))
        .where(F.col("disclosure") >= GENERALISE)
        .groupBy("term")
        .agg(F.max("disclosure").alias("disclosure"))
    )
    return materialize(terms, "op10-terms"), whole


# -- spans --------------------------------------------------------------------------------


def _named(spans: str, kind: str) -> Column:
    """The spans as (kind, start, end)."""
    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with base (array of kind, start, end) and terms (array of start, end, disclosure).

    ``base`` holds the patterns' spans by kind and start; ``terms`` the spans of revealing terms
    by start, without those that touch a base span.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("__text", text)
    out = base_spans(keyed, "__text").withColumn("base", F.concat(*(_named(k, k) for k in KINDS)))
    key = F.unhex(F.sha2("__text", 256))
    spanned = out.where(F.size("base") > 0).select("__text", key.alias("__key"), *KINDS)
    spanned = materialize(spanned, "op10-spans")
    texts = docs.select(text.alias("__text")).withColumn("__key", key)
    found = revealing_terms(texts, spanned)
    none = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    if found is None:
        return out.withColumn("terms", none).drop("__text")
    terms, occurrences = found
    hits = (
        occurrences.join(terms, "term")
        .groupBy(F.col("key").alias("__key"))
        .agg(F.map_from_entries(F.collect_set(F.struct("term", "disclosure"))).alias("reveal"))
    )
    hits = materialize(hits, "op10-hits")
    length = F.aggregate(F.map_keys("reveal"), F.lit(0), lambda n, t: n + F.octet_length(t) + 32)
    hits = _broadcast_if_small(hits, length)

    def placed(reveal: Column) -> Column:
        found = F.transform(
            matches(F.col("__text"), r"[^\x20\x09-\x0D]+"),
            lambda w: F.struct(
                (w["start"] + F.length(F.regexp_extract(w["value"], r"^[^\p{L}\p{N}]*", 0))).alias("start"),
                (w["end"] - F.length(F.regexp_extract(w["value"], r"[^\p{L}\p{N}]*$", 0))).alias("end"),
                F.try_element_at(reveal, _term(w["value"])).alias("disclosure"),
            ),
        )
        return F.filter(
            found,
            lambda w: w["disclosure"].isNotNull()
            & ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
        )

    out = out.withColumn("__key", key).join(hits, "__key", "left")
    out = out.withColumn("terms", F.when(F.col("reveal").isNull(), none).otherwise(placed(F.col("reveal"))))
    return out.drop("__text", "__key", "reveal")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row.

    Defined results: a null text is empty and has no spans (the hash is that of the empty
    string); repeated rows come back once each; of overlapping kinds all spans are reported; an
    empty table gives an empty result; other columns are ignored.
    """
    out = find_spans(docs.select("doc_id", "text"))
    return out.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", _named("terms", "term"))).alias("spans"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and revealing terms generalised or removed.

    All columns of ``docs`` come back, in order; rows without spans keep their text as it is,
    null included.  Overlapping spans are masked as one, by the first of them.
    """
    columns = docs.columns
    wide = docs.select(*(column(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col("text"))
    out = find_spans(wide)
    text = F.col("text").cast("string")
    masks = F.create_map(*(F.lit(x) for pair in MASKS.items() for x in pair))
    base = F.transform(
        "base",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(masks, s["kind"]).alias("mask")),
    )

    def generalised(s: Column) -> Column:
        word = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        return (
            F.when(s["disclosure"] >= REMOVE, "")
            .when(word.rlike(r"^[\p{N}]+$"), "[NUMBER]")
            .when(word.rlike(r"^\p{Lu}"), "[NAME]")
            .otherwise("[TERM]")
        )

    terms = F.transform(
        "terms",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), generalised(s).alias("mask")),
    )

    spans = F.sort_array(F.concat(base, terms))
    clean = F.when(F.size("base") + F.size("terms") > 0, bound(spans, lambda x: masked(text, x))).otherwise(text)
    at = columns.index("text")
    return out.select(
        *(clean.alias("text") if i == at else F.col(f"c{i}").alias(c) for i, c in enumerate(columns))
    )
