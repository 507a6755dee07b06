"""The pipeline: its stages on edge cases, and the whole of it on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from tidepool.llm import language_id, quality_classifier

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "kept"]


def edge_docs(spark):
    base = "the quick brown fox jumps over the lazy dog and then it sleeps"
    rows = [
        (1, base, "en", "s", 1, "x"), (2, base, None, None, None, None), (3, None, "en", "s", 0, "x"),
        (4, "", "en", "s", 0, "x"), (5, "write to a@b.example or 10.0.0.1", "en", "s", 3, "x"),
        (None, "a text without id", "en", "s", 3, "x"), (1, base, "en", "s", 1, "x"),
        (6, " ".join(f"w{i}" for i in range(25_000)), "en", "s", 2, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


def test_stages_on_edge_cases(spark):
    docs = edge_docs(spark)
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name != "packing":
            assert out.columns == COLUMNS
            assert out.count() <= docs.count()
    by_id = {r.doc_id for r in corpus_pipeline.dedup_stage(spark, docs, SF).collect()}
    assert by_id == {1, 3, 4, 5, 6, None}
    texts = {r.doc_id: r.text for r in corpus_pipeline.pii_stage(spark, docs, SF).collect()}
    assert texts[5] == "write to [EMAIL] or [IP]" and texts[3] is None


def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()}
    good = {r.doc_id for r in quality_classifier.score_documents(docs, labels).where("predicted = 1").collect()}
    assert kept == good
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    named = language_id.identify(docs).where("lang_pred <> 'und'")
    assert kept == {r.doc_id for r in named.collect()}


def test_rows_have_verdicts_of_their_own(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_classifier.score_documents(docs, labels).join(docs.select("doc_id", "text"), "doc_id")
    good, bad = (scored.where(f"predicted = {k}").orderBy("doc_id").first()["text"] for k in (1, 0))
    words = [f"word{k}" for k in range(60)]
    rows = [
        (900001, good, "en", 1), (900001, bad, "en", 2), (None, good, "en", 3), (None, bad, "en", 4),
        (900002, "12 34", "en", 5), (900002, good + " more", "en", 6),
        (900003, " ".join(words), "en", 7), (900003, " ".join(words[::-1]), "en", 8), (None, " ".join([*words, "x"]), "en", 9),
        (None, "a lonely row without an id and without a copy", "en", 10), (900004, " ".join([*words, "y"]), "en", 11),
    ]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` int")
    wide = docs.select("doc_id", "text", "lang").unionByName(extra, allowMissingColumns=True)
    marks = lambda df: {r["a.b"] for r in df.where("`a.b` is not null").collect()}
    assert {1, 3} <= marks(corpus_pipeline.quality_stage(spark, wide, SF)) and not {2, 4} & marks(
        corpus_pipeline.quality_stage(spark, wide, SF)
    )
    assert marks(corpus_pipeline.language_stage(spark, wide, SF)) == set(range(1, 12)) - {5}
    only = corpus_pipeline.dedup_stage(spark, extra.where("`a.b` >= 7"), SF)
    assert only.columns == extra.columns and marks(only) == {7, 8, 10}
    assert corpus_pipeline.pii_stage(spark, extra, SF).columns == extra.columns


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    per_doc: dict = {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in per_doc.values():
        assert sum(n for _, n, _ in parts) == parts[0][2]


def test_multilingual_documents_stay(spark):
    words = {name: [f"{name}{k}{name}" for k in range(30)] for name in ("qua", "wex", "zol")}
    rows = [(k, " ".join(words[name]), name, "s", 1, "x") for name in words for k in range(20)]
    rows.append((99, " ".join(w for name in words for w in words[name]), None, "s", 1, "x"))
    docs = spark.createDataFrame(rows, edge_docs(spark).schema)
    assert 99 in {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    named = language_id.identify(docs).where("doc_id = 99").first()
    assert len(named.languages) == 3 and named.score < 0.4
