"""The corpus operators against brute force on small tables, and their defined edge cases."""

from __future__ import annotations

import hashlib
import random
import math
import itertools
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import (
    bpe,
    embedding_dedup,
    language_id,
    minhash_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    quotes,
    sharding,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again", "en", "s", 1),
        (2, "The quick brown FOX jumps over the lazy dog again", "en", "s", 1),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \n\t ", None, "s", 3),
        (6, long, "en", "s", 9),
        (7, long + " tail", "en", "s", 9),
        (8, "one two", "de", "s", 7),
        (9, "ONE\ttwo", "de", "s", 7),
        (10, "12345 !!! ###", "de", "s", 7),
        (1, "the quick brown fox jumps over the lazy dog again", "en", "s", 1),
        (None, "a row without an id but with words", "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("kept", "component", "score", "node", "rank", "base", "terms", "value", "start", "label"):
        df = df.selectExpr("*", f"'x' as {name}")
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- 1 ------------------------------------------------------------------------------------


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(texts: dict, percent: int):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    return {k: (len(sets[k]), root(k)) for k in names}


def near_copies(seed: int, groups: int, size: int) -> dict:
    rng = random.Random(seed)
    texts, number = {}, 0
    for _ in range(groups):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 160))]
        for _ in range(rng.randrange(1, size)):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            texts[number] = " ".join(copy)
            number += 1
    return texts


def test_near_duplicates_match_brute_force(spark):
    texts = near_copies(1, 40, 9)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(minhash_dedup.near_duplicates(df))}
    assert got == brute_components(texts, 85)


def test_large_nodes_are_cut_and_still_complete(spark, monkeypatch):
    texts = near_copies(2, 3, 60)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(minhash_dedup, "PIECE_SHINGLES", 600)
    want = brute_components(texts, 85)
    for depth in (16, 2):  # branching on, and the exhaustive end
        monkeypatch.setattr(minhash_dedup, "MAX_DEPTH", depth)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(minhash_dedup.near_duplicates(df))}
        assert got == want


def test_each_text_of_a_shared_id_links(spark):
    rng = random.Random(8)
    one, two = ([f"{x}{rng.randrange(9999)}" for _ in range(200)] for x in "ab")
    rows = [
        (1, " ".join(one)), (1, " ".join(two)), (2, " ".join(one + ["tail"])), (3, " ".join(two + ["tail"])),
        (1, " ".join(two)), (7, " ".join(rng.choices(one, k=90))), (1, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(minhash_dedup.near_duplicates(df))
    assert len(got) == 7
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 1, 7: 7}


@pytest.mark.parametrize("percent", [80, 85])
def test_bands_find_pairs_at_the_threshold(percent):
    width = minhash_dedup.band_width(percent)
    rng = np.random.default_rng(percent)
    same = rng.random((100_000, minhash_dedup.COORDINATES)) < percent / 100
    left = rng.integers(0, 2**32, same.shape, dtype=np.uint32)
    right = np.where(same, left, left + np.uint32(1))
    hit = (minhash_dedup.bands(left, width) == minhash_dedup.bands(right, width)).any(axis=1)
    assert width == 3 and (~hit).sum() <= 1


def test_likely_rows_have_a_partner_of_another_component_in_their_piece():
    import pandas as pd

    rng = np.random.default_rng(9)
    rows = [
        (node, piece, 100 * node + k, int(rng.integers(0, 3)), rng.integers(0, 6, 4, dtype=np.uint32))
        for node in range(4) for piece in range(3) for k in range(int(rng.integers(1, 9)))
    ]
    frame = pd.DataFrame(rows, columns=["node", "piece", "rep", "component", "bands"])
    want = {
        (a[0], a[1], a[2])
        for a in rows
        for b in rows
        if a[:2] == b[:2] and a[3] != b[3] and (a[4] == b[4]).any()
    }
    frame["bands"] = [x.tobytes() for x in frame["bands"]]
    parts = [frame.iloc[k : k + 5] for k in range(0, len(frame), 5)]
    got = pd.concat(list(minhash_dedup._likely(iter(parts))))
    assert {tuple(x) for x in got[["node", "piece", "rep"]].to_numpy().tolist()} == want


def test_nothing_but_the_sketches_stays_in_the_shared_folder(spark):
    import os

    from tidepool.session import checkpoint_root

    root = f"{checkpoint_root(spark).removeprefix('file:')}/tidepool"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    df = spark.createDataFrame(list(near_copies(5, 4, 6).items()), "doc_id long, text string")
    assert minhash_dedup.near_duplicates(df).count()
    left = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before)
    assert set(left) <= {"op1-sketch", "op1-classes", "op1-shared", "op1-labels", "op1-edges"}, left
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("op1_")]


def test_pieces_of_many_short_texts_fit_in_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 30_000, 5).astype(np.uint64)) for _ in range(6000)]
    sets += sets[:50]
    tracemalloc.start()
    i, j = minhash_dedup.linked_pairs(sets, 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(zip(i.tolist(), j.tolist())) >= {(k, 6000 + k) for k in range(50)}
    assert all(2 * len(np.intersect1d(sets[a], sets[b])) > len(sets[a]) for a, b in zip(i, j))
    assert peak < 300e6  # 6050 ** 2 * 20 bytes are 730 MB


def test_linked_pairs_match_brute_force_over_blocks(monkeypatch):
    monkeypatch.setattr(minhash_dedup, "CELLS", 600)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 12, rng.integers(1, 12)).astype(np.uint64)) for _ in range(120)]
    i, j = minhash_dedup.linked_pairs(sets, 60)
    want = set()
    for b in range(120):
        for a in range(b):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 60 * (len(sets[a]) + len(sets[b]) - common):
                want.add((a, b))
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_near_duplicates_edges(edge, empty):
    got = rows_of(minhash_dedup.near_duplicates(edge))
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["component_id"] for k in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 3, 4, 5, 6, 6, 8, 8]
    assert by[3]["n_shingles"] == 0 and by[8]["n_shingles"] == 1 and by[None]["kept"]
    assert minhash_dedup.near_duplicates(empty).count() == 0


# -- 2, 8 ---------------------------------------------------------------------------------


def test_language_held_out_accuracy(documents):
    got = rows_of(language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id"))
    test = [r for r in got if r["held_out"]]
    assert test and all(r["held_out"] == held(r["doc_id"]) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.97 * len(test)


def test_language_edges(edge, empty):
    got = rows_of(language_id.identify(edge))
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert {k for k, r in by.items() if r["lang_pred"] == "und"} == {3, 4, 5, 10}
    assert all(0 <= r["score"] <= 1 for r in got) and by[3]["score"] == 0
    assert language_id.identify(empty).count() == 0


def test_mixture_proportions():
    words = np.array([[-1.0, -9.0]] * 30 + [[-9.0, -1.0]] * 10, dtype=np.float32)
    best, share = language_id.proportions(words, np.array([40]))
    assert best[0] == 0 and 0.7 < share[0] < 0.8
    best, share = language_id.proportions(words[:31], np.array([31]))  # one foreign word is no second language
    assert best[0] == 0 and share[0] == 1.0


def test_mixture_of_many_languages():
    parts = np.repeat(np.arange(5), [35, 25, 20, 20, 0])
    words = np.full((100, 5), -12.0, dtype=np.float32)
    words[np.arange(100), parts] = -1.0
    mixed = language_id.mixtures(words, np.array([100]))[0]
    assert np.abs(mixed - [0.35, 0.25, 0.2, 0.2, 0]).max() < 0.01 and mixed[4] == 0


def test_many_languages_are_refused_before_collecting(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 3)
    monkeypatch.setattr(language_id, "_count", None)  # nothing is counted
    rows = [(k, "a few words", f"l{k % 9}", "s", 1) for k in range(90)]
    with pytest.raises(ValueError, match="languages"):
        language_id.train(spark.createDataFrame(rows, DOCS))


def test_quality_classifier(documents, labels, edge, empty):
    got = rows_of(quality_classifier.score_documents(documents, labels).join(labels, "doc_id"))
    test = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in test) >= 0.85 * len(test)
    scored = rows_of(quality_classifier.score_documents(edge, labels))
    assert len(scored) == edge.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] in (3, 4)}) == 1
    assert quality_classifier.score_documents(empty, labels).count() == 0
    none = rows_of(quality_classifier.score_documents(edge, labels.limit(0)))
    assert {r["score"] for r in none} == {0.5}


def test_classifier_sample_is_held_once_on_the_driver(documents, labels, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_classifier, "train", lambda samples: seen.extend(samples) or (None, 0.0))
    quality_classifier.fit(documents, labels)
    assert seen and all(ids.dtype == np.uint16 and not ids.flags.owndata for _, ids, _ in seen)
    assert all(len(ids) == len(weights) and abs(weights.sum() - 1) < 1e-3 for _, ids, weights in seen if len(ids))


# -- 3 ------------------------------------------------------------------------------------


def check_packing(texts, got):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.vocabulary_path(packing.VOCABULARY))
    want = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for a in range(0, len(ids), 4096):
            piece = np.array(ids[a : a + 4096], dtype="<u4")
            want[doc_id, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return bins


def test_packing(documents, edge, empty):
    texts = [(r["doc_id"], r["text"]) for r in rows_of(documents.select("doc_id", "text"))]
    bins = check_packing(texts, rows_of(packing.pack(documents)))
    filled = sum(n for parts in bins.values() for _, n in parts)
    assert filled > 0.97 * 4096 * (len(bins) - 1)
    check_packing([(r["doc_id"], r["text"]) for r in rows_of(edge.select("doc_id", "text"))], rows_of(packing.pack(edge)))
    assert packing.pack(empty).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(4)
    sizes = np.array([rng.randrange(1, 100) for _ in range(300)])
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room: list[int] = []
    for i in sorted(range(300), key=lambda k: (-sizes[k], k)):
        b = next((k for k, free in enumerate(room) if free >= sizes[i]), None)
        if b is None:
            room.append(100)
            b = len(room) - 1
        assert (bins[i], offsets[i]) == (b, 100 - room[b])
        room[b] -= sizes[i]


# -- 4 ------------------------------------------------------------------------------------


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((30, 16))
        for k in range(300):
            base = centres[k % 30]
            rows.append((len(rows), (base + rng.standard_normal(16) * rng.choice([0.03, 0.3])).astype(np.float32).tolist(), label))
    rows += [(9000 + k, rows[k][1], rows[k][2]) for k in range(0, 40, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in rows_of(embedding_dedup.near_duplicates(df))}
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab, ids = np.array([r[2] for r in rows]), [r[0] for r in rows]
    link = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    want, have = int(link.sum()), sum(r["n_links"] for r in got.values())
    assert 0.98 * want <= have <= want
    component = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.array([min(component[i], component[link[i]].min(initial=component[i])) for i in range(len(ids))])
        if (new == component).all():
            break
        component = new
    wrong = sum(got[ids[i]]["component_id"] != ids[component[i]] for i in range(len(ids)))
    assert wrong <= 0.02 * len(ids)


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.0], 1, "x"), (3, [2.0, 0.0], 1, "x"), (4, [1.0, 0.0], 2, "x"),
        (5, [1.0, 0.0], None, "x"), (6, None, 1, "x"), (7, [0.0, 0.0], 1, "x"), (8, [nan, 1.0], 1, "x"),
        (9, [inf, 1.0], 1, "x"), (10, [None, 1.0], 1, "x"), (11, [], 1, "x"), (12, [1.0], 1, "x"),
        (None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")
    got = rows_of(embedding_dedup.near_duplicates(df))
    assert len(got) == len(rows)
    by = {r["vec_id"]: r for r in got}
    assert [by[k]["n_links"] for k in range(1, 13)] == [3, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    assert [by[k]["component_id"] for k in range(1, 13)] == [1, 1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_tables_follow_the_cells():
    chance = embedding_dedup.cell_chance()
    rng = np.random.default_rng(1)
    gap = rng.standard_normal(200_000) * np.sqrt(2 - 2 * embedding_dedup.COSINE)
    assert abs(np.maximum(0, 1 - np.abs(gap) / embedding_dedup.CELL).mean() - chance) < 2e-3
    for cells in range(24):  # 24: labels of 10**13 vectors
        tables = embedding_dedup.directions(3, cells)[1].shape[0]
        assert (1 - chance**cells) ** tables <= embedding_dedup.MISS


def test_pairs_past_the_window_of_one_table_are_found_in_another(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BUCKET", 1 << 20)  # labels of one bucket and many blocks
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(0, 8000, 2):
        base, side = rng.standard_normal(64), rng.standard_normal(64)
        side -= base * (side @ base) / (base @ base)
        side *= np.linalg.norm(base) / np.linalg.norm(side)
        pair = base * 0.98001 + side * np.sqrt(1 - 0.98001**2)
        rows += [(k, base.tolist(), k % 4), (k + 1, pair.tolist(), k % 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in rows_of(embedding_dedup.near_duplicates(df))}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    want = 0
    for name in set(label.tolist()):
        part = x[label == name]
        want += int((part @ part.T >= 0.98).sum()) - len(part)
    have = sum(got.values())
    assert 0.998 * want <= have <= want


def test_a_hot_label_does_not_cut_small_ones(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BUCKET", 2)
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(32).tolist(), 0) for k in range(3000)]  # seven cells
    for k in range(3000, 3400, 2):  # 200 labels of one pair at the threshold: no cells
        base = rng.standard_normal(32)
        side = rng.standard_normal(32)
        side -= base * (side @ base) / (base @ base)
        side *= np.linalg.norm(base) / np.linalg.norm(side)
        pair = base * 0.9801 + side * np.sqrt(1 - 0.9801**2)
        rows += [(k, base.tolist(), k), (k + 1, pair.tolist(), k)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in rows_of(embedding_dedup.near_duplicates(df))}
    assert sum(got[k] == 1 for k in range(3000, 3400)) == 400


def test_a_dense_group_is_spread_over_chunk_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 50)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    seen = []
    links = embedding_dedup.chunk_pairs
    monkeypatch.setattr(embedding_dedup, "chunk_pairs", lambda r: (seen.append(links(r)), seen[0])[1])
    rng = np.random.default_rng(5)
    base = rng.standard_normal(24)
    rows = [(k, (base + rng.standard_normal(24) * 0.01).tolist(), 1) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = rows_of(embedding_dedup.near_duplicates(df))
    assert {(r["n_links"], r["component_id"]) for r in got} == {(599, 0)}
    tasks = seen[0].groupBy("first", "second").count().collect()
    assert len(tasks) > 3 * 12 * 12 / 2 and max(r["count"] for r in tasks) <= 2 * 50


def test_extreme_vectors_link(spark):
    rows = [
        (1, [1e200, 0.0], "x"), (2, [2e200, 0.0], "x"), (3, [1e-200, 0.0], "x"), (4, [0.0, 5e-324], "x"),
        (5, [0.0, 1.0], "x"), (6, [1.7e308, 1.7e308], "x"), (7, [3.0, 3.0], "x"), (8, [float("inf"), 0.0], "x"),
        (9, [0.0, 0.0], "x"), (10, [1e150, 1e149], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows_of(embedding_dedup.near_duplicates(df))}
    assert got == {
        1: (3, 1), 2: (3, 1), 3: (3, 1), 10: (3, 1), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9)
    }


# -- 5 ------------------------------------------------------------------------------------

ODD = [
    "", " ", "a" * 3000, "  \n\n  x", "<|endoftext|>hi<|endoftext|> <|startoftext|>", "don't we'll  I'VE\t x",
    "x y   z ", "'s 'll ''s a's a'step 12's ...'s b'S", "日本 😀😀 é́ ՘࢏", "ß ﬁ Ǆ İ ΣΑΣ",
]


def test_bpe_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.vocabulary_path(bpe.VOCABULARY))
    texts = [(k, t) for k, t in enumerate([None, *ODD])]
    texts += [(100 + r["doc_id"], r["text"]) for r in rows_of(documents.limit(60))]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    got = {r["doc_id"]: r for r in rows_of(bpe.digests(df))}
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    decoded = {r["doc_id"]: r["text"] for r in rows_of(bpe.decode(bpe.encode(df)))}
    assert decoded == {k: t or "" for k, t in texts}
    assert bpe.digests(df.limit(0)).count() == 0


# -- 6 ------------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def brute_mcd(points):
    """Count, mean and covariance of the subset of 75 % with the smallest floored determinant, of all subsets."""
    floor = np.diag(np.square(quality_rules.FLOOR))
    best = None
    for subset in itertools.combinations(range(len(points)), math.ceil(quality_rules.COVER * len(points))):
        own = points[list(subset)]
        scatter = np.cov(own.T, bias=True) * quality_rules.CONSISTENCY
        size = np.linalg.slogdet(scatter + floor)[1]
        if best is None or size < best[0] - 1e-12:
            best = (size, len(own), own.mean(axis=0), scatter)
    return best[1:]


def combined(own, wider):
    n, mean, scatter = own
    share, apart = n / (n + quality_rules.PRIOR), mean - wider[1]
    mixed = share * scatter + (1 - share) * wider[2] + share * (1 - share) * np.outer(apart, apart)
    return n, share * mean + (1 - share) * wider[1], mixed


def test_outliers_match_brute_force(spark):
    """All subsets are tried for every group, language and the whole; then every distance is compared."""
    draw = np.random.default_rng(11)
    scale = np.array([0.2, 0.1, 0.3, 0.2, 0.1])
    # a quarter of every group lies far off, so the best subset is the rest, at every level
    groups = {("=a", "=x"): 8, ("=a", "=y"): 4, ("=b", "=x"): 4, ("=b", ""): 1}
    data = {}
    for k, n in groups.items():
        points = draw.normal(size=(n, 5)) * scale * 0.5 + 1.0
        points[: n // 4] += 30 * scale * (1 + np.arange(n // 4)[:, None])
        data[k] = points
    rows = [(*k, *map(float, point)) for k, points in data.items() for point in points]
    vectors = spark.createDataFrame(rows, "g1 string, g2 string, " + ", ".join(f"x{i} double" for i in range(5)))
    got = {(r["g1"], r["g2"]): r for r in rows_of(quality_rules._group_estimates(vectors))}
    assert set(got) == set(groups)
    top = brute_mcd(np.concatenate(list(data.values())))
    floor = np.diag(np.square(quality_rules.FLOOR))
    for k, points in data.items():
        language = brute_mcd(np.concatenate([v for (g, _), v in data.items() if g == k[0]]))
        _, mean, scatter = combined(brute_mcd(points), combined(language, top))
        assert np.allclose([got[k][f"m{i}"] for i in range(5)], mean)
        factor = np.linalg.cholesky(scatter + floor)
        assert np.allclose([got[k][f"l{i}_{j}"] for i in range(5) for j in range(i + 1)], factor[np.tril_indices(5)])
        far = np.square(np.linalg.solve(factor, (points - mean).T)).sum(axis=0) > quality_rules.CUTOFF
        assert far.tolist() == [i < len(points) // 4 for i in range(len(points))]


def test_small_groups_reject_outliers(spark):
    """A source of three documents has its own verdicts, as has a table of a few documents."""
    clean = lambda k: " ".join(f"word{(i * 7 + k) % 211} und" for i in range(40 + k % 9))
    junk = " ".join(f"##{i}## $$|%%" for i in range(60))
    rows = [(k, clean(k), "de", "big", 0) for k in range(60)]
    rows += [(100, clean(3), "de", "small", 0), (101, clean(5), "de", "small", 0), (102, junk, "de", "small", 0)]
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(spark.createDataFrame(rows, DOCS)))}
    assert {k for k, v in kept.items() if not v} == {102}
    few = spark.createDataFrame([r for r in rows if r[0] >= 55], DOCS)
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(few))}
    assert {k for k, v in kept.items() if not v} == {102}


def test_quality_rules(spark, documents, labels, edge, empty):
    texts = {r["doc_id"]: r["text"] for r in rows_of(documents.select("doc_id", "text"))}
    got = rows_of(quality_rules.judge(documents))
    for r in got:
        n, chars, symbols, lines, repeats = brute_counts(texts[r["doc_id"]])
        counted = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert counted == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    quality = {r["doc_id"]: r["quality"] for r in rows_of(labels)}
    judged = [r for r in got if not r["base_failed"] and r["doc_id"] in quality]
    assert all(r["kept"] for r in judged if quality[r["doc_id"]] == 1)
    assert not any("Python" in line for line in quality_rules.judge(documents)._jdf.queryExecution().toString().split())
    assert len(rows_of(quality_rules.judge(edge))) == edge.count()
    assert quality_rules.judge(empty).count() == 0


# -- 7 ------------------------------------------------------------------------------------


def test_whole_strings_make_the_levels(spark):
    names = [f"https://{'abcdefghij'[k % 10]}{k:04d}.example" for k in range(1000)]
    few = spark.createDataFrame([(x,) for x in names[:3] * 4 + [None]], "source string")
    cuts = sharding.string_cuts(few, "source")
    levels = sharding._string_level(cuts, sharding.pd.Series([None, *sorted(names[:3])]))
    assert levels.tolist() == [0, 1, 2, 3]
    many = spark.createDataFrame([(x,) for x in names], "source string")
    cuts = sharding.string_cuts(many, "source")
    levels = sharding._string_level(cuts, sharding.pd.Series(sorted(names)))
    assert (np.diff(levels) >= 0).all() and levels.min() == 1 and levels.max() < 1 << sharding.BITS
    assert max(Counter(levels.tolist()).values()) <= 4
    assert len(sharding.string_cuts(many.limit(0), "source")) == 0


def test_written_shards_hold_all_columns(spark, tmp_path):
    rows = [(k, None if k % 7 == 0 else "x" * k, "en", f"https://{k % 3}", 5, 6, 7, 8) for k in range(53)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size int, rank int, curve int, `a.b` int"
    )
    sharding.write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(back.columns) == sorted([*df.columns, "shard"])
    assert sorted(map(str, back.drop("shard").select(*(f"`{c}`" for c in df.columns)).collect())) == sorted(
        map(str, df.collect())
    )
    want = {r["doc_id"]: r["shard"] for r in rows_of(sharding.shard(df))}
    assert {r["doc_id"]: r["shard"] for r in rows_of(back)} == want
    clash = df.withColumn("shard", F.lit("mine"))
    sharding.write_shards(clash, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.where("shard = 'mine'").count() == 53 and "_shard" in back.columns


def test_sharding(documents, edge, empty):
    for df in (documents, edge):
        got = rows_of(sharding.shard(df))
        texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows_of(df.select("doc_id", "text")))
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
        slots: dict = {}
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
        counts = [len(slots.get(s, [])) for s in range(8)]
        assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    assert sharding.shard(empty).count() == 0


def test_hilbert_neighbours_are_adjacent():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        place = sharding.hilbert_index(grid, bits)
        assert sorted(place) == list(range(len(grid)))
        path = grid[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shard_files_prune(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count() and set(documents.columns) <= set(back.columns)
    assert back.select("shard").distinct().count() == 8


# -- 9 ------------------------------------------------------------------------------------

TALK = [
    (1, 0, "user", "Hello there\nHow are  you?\n\nBye"), (1, 1, "assistant", "On Monday, X wrote:\n> how are you?\nFine"),
    (1, 2, "user", "> > How are you?\n> Fine\nGood"), (1, 3, "user", "> Hello there\nsecond"), (1, 4, "user", "other"),
    (1, 5, "user", ">second\n>> Hello there\nyes"), (1, 5, "user", ">second\n>> Hello there\nyes"),
    (2, 0, "user", None), (2, 1, None, "> Hello there\nx"), (None, 1, "u", "> a"), (3, None, "u", "a\n> a"), (4, 0, "u", ""),
]


#: Whole passages against single lines, nested levels, attributions of several languages, re-wrapped
#: quotes, repeated rows and a turn with two texts.
PASSAGES = [
    (7, 0, "a", "ja\nnein"), (7, 1, "a", "Vielleicht\nja"), (7, 2, "b", "ja"),
    (7, 3, "c", "X ha scritto:\n>  JA\n>\nnon lo so"), (7, 4, "d", "> ja\n>\n> Nein\nklar:"),
    (7, 5, "e", "Klar, siehe:\n> nirgends gesagt\nalso:\n> klar:\n>> ja\n>> nein\nEnde"),
    (7, 6, "f", "> vielleicht ja\n> nein\nhm"), (7, 6, "f", "> vielleicht ja\n> nein\nhm"), (7, 6, "f", "z:\n> hm"),
    (7, 7, "g", "：\n>> Ende\n> Ende\n"), (7, 8, "h", "> " * 40 + "ende"), (8, 1, "a", "> ja"),
    (8, 2, "a", "\r\n>\n>>\n"), (8, 3, "a", " > Ja:\n"), (8, 4, "b", "hinten:\n> ja:"), (8, 9, "b", "ja:\n\n> ja:"),
]


def test_passages_before_lines(spark):
    df = spark.createDataFrame(PASSAGES, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"], r["role"]): r for r in rows_of(quotes.reply_order(df))}
    assert got[7, 3, "c"]["parent_turn"] == 2  # who said just that, not who said it first among other lines
    assert got[7, 3, "c"]["body"] == "non lo so"
    assert got[7, 4, "d"]["parent_turn"] == 0 and got[7, 4, "d"]["body"] == "klar:"
    answer = got[7, 5, "e"]  # the attribution of an unlinked quote stays
    assert (answer["parent_turn"], answer["n_linked"], answer["max_level"]) == (4, 3, 2)
    assert answer["body"] == "Klar, siehe:\nEnde" and answer["root_turn"] == 0
    assert got[7, 6, "f"]["parent_turn"] in (0, 5) and got[7, 8, "h"]["max_level"] == 40


@pytest.mark.parametrize("talk", ["TALK", "PASSAGES", "random"])
def test_quotes_match_sql(spark, talk):
    if talk == "random":
        draw = np.random.default_rng(5)
        line = lambda: "> " * int(draw.integers(0, 3)) + " ".join(draw.choice(["ja", "no", "so:", ""], 2))
        talk = [(int(draw.integers(0, 9)), k, "u", "\n".join(line() for _ in range(int(draw.integers(1, 6))))) for k in range(300)]
    else:
        talk = {"TALK": TALK, "PASSAGES": PASSAGES}[talk]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as body", "1 as depth")
    got = rows_of(quotes.reply_order(df))
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", talk)
    cursor = con.execute(quotes.ORACLE_SQL)
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r)) for r in cursor.fetchall()]
    line = lambda r: repr(sorted(r.items()))
    assert sorted(map(line, got)) == sorted(map(line, want))
    assert quotes.reply_order(df.limit(0)).count() == 0


# -- 10 -----------------------------------------------------------------------------------

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def test_personal_data(spark, documents):
    rng = random.Random(3)
    odd = [None, "", "a@b.c_x@d.e.f", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0256", "é😀 x@y.zz +1 (377) 555-0271 4111 1111 1111 1111", "9" * 5000, "1 " * 3000]
    odd += ["".join(rng.choice("ab0123456789.@+- ()_%é\n") for _ in range(rng.randrange(60))) for _ in range(400)]
    odd += [" ".join(rng.choice(["4111111111111111", "1.2.3.4", "+1 555 123 4567", "q.r@s.tu", "x"]) for _ in range(1500))]
    texts = [(10**6 + k, t) for k, t in enumerate(odd)] + [(r["doc_id"], r["text"]) for r in rows_of(documents.select("doc_id", "text"))]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' as base", "'x' as email")
    got = {r["doc_id"]: r for r in rows_of(pii.detect(df))}
    for doc_id, text in texts:
        spans = brute_spans(text)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[doc_id]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert ",".join(s for s in r["spans"].split(",") if s and not s.startswith("term")) == base
    clean = {r["doc_id"]: r for r in rows_of(pii.sanitise(df))}
    assert set(clean[0]) == {"doc_id", "text", "base", "email"} and len(clean) == len(texts)
    for doc_id, text in texts:
        if not got[doc_id]["spans"]:
            assert clean[doc_id]["text"] == text
    assert clean[10**6 + 4]["text"].startswith("é😀 [EMAIL]")
    assert pii.detect(df.limit(0)).count() == 0 and pii.sanitise(df.limit(0)).count() == 0


def test_revealing_terms(spark):
    filler = [f"plain text number {k} about the weather and the sea" for k in range(400)]
    near = [f"harbour master Quorvex likes sea number {k} write to boss@port.example today" for k in range(6)]
    df = spark.createDataFrame(list(enumerate(filler + near + ["Quorvex was seen again"])), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in rows_of(pii.detect(df))}
    assert "term:0:7" in got[406]  # reveals the address without it
    assert all(got[k] == "" for k in range(400))
    clean = {r["doc_id"]: r["text"] for r in rows_of(pii.sanitise(df))}
    assert "quorvex" not in " ".join(clean.values()).lower() and "boss@" not in " ".join(clean.values())


def test_copies_hide_no_revealing_terms(spark):
    texts = [f"plain text number {k} about the weather and the sea" for k in range(400)]
    near = [f"harbour master Quorvex likes sea number {k} write to boss@port.example today" for k in range(6)]
    copied = "the ship Zanthu lies at sea number one and no mail but crew@ship.example reaches her"
    texts += [t for t in near for _ in range(10)] + [copied] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in rows_of(pii.detect(df))}
    assert all("term:15:22" in got[k] for k in range(400, 460))
    assert all("term" not in got[k] for k in range(460, 510))  # copies alone are no evidence


def test_terms_at_the_border_and_far_away_reveal(spark):
    rng = random.Random(9)
    texts = [f"plain text number {k} about the weather and the sea" for k in range(400)]
    texts += [f"Quorvex boss@port.example text number {k}" for k in range(5)]
    texts += [f"text number {k} boss@port.example Vantrel" for k in range(5)]
    for k in range(5):
        between = " ".join(f"w{rng.randrange(50)}" for _ in range(80))
        texts.append(f"text {k} Oldmarn {between} crew@ship.example about number {k}")
    texts += ["Oldmarn the sea", "plain 555"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in rows_of(pii.sanitise(df))}
    left = " ".join(clean.values())
    assert not any(name in left for name in ("Quorvex", "Vantrel", "Oldmarn", "boss@", "crew@"))
    assert all(clean[k] == texts[k] for k in range(400))


# -- 8, features and training against brute force ----------------------------------------------


def brute_features(text):
    """Counter of (kind, value): words, same-word pairs, character n-grams."""
    words = WORD.findall(text)
    flat = re.sub(r"[\x20\x09-\x0D]", " ", text)
    out = Counter(("word", w) for w in words)
    out.update(("again", a == b) for a, b in zip(words, words[1:]))
    for n in quality_classifier.GRAMS:
        out.update((n, flat[i : i + n]) for i in range(len(flat) - n + 1))
    return out


def one_text(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return quality_classifier.features(data, np.array([0, len(data)]))


def test_classifier_features_are_brute_force():
    texts = ["the the the", "", " \t", "a", "Ünï cödé ß 日本語 日本語 🎉🎉", "a\tb\nc a  b", "the the the", "x" * 50]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = quality_classifier.features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    names: dict = {}
    for k, text in enumerate(texts):
        got = [np.sort(b[lo[k] : hi[k]]).tolist() for b, lo, hi in together]
        alone = [np.sort(b[lo[0] : hi[0]]).tolist() for b, lo, hi in one_text(text)]
        assert got == alone  # neighbours in the batch change nothing
        want = brute_features(text)
        kinds = ["word", "again", *quality_classifier.GRAMS]
        for kind, buckets in zip(kinds, got):
            counts = sorted(n for (of, _), n in want.items() if of == kind)
            assert sorted(Counter(buckets).values()) == counts  # no two features of these texts collide
        assert Counter(got[1]) == Counter(int(v) for (of, v), n in want.items() if of == "again" for _ in range(n))
        for word in set(WORD.findall(text)):
            assert names.setdefault(word, one_text(word)[0][0][0]) >= quality_classifier.SHAPES
            assert names[word] in got[0]


def test_classifier_training_step_is_brute_force(monkeypatch):
    monkeypatch.setattr(quality_classifier, "EPOCHS", 1)
    monkeypatch.setattr(quality_classifier, "BUCKETS", 12)
    rng = np.random.default_rng(3)
    samples = []
    for k in range(9):
        ids = np.sort(rng.choice(12, 4, replace=False))
        samples.append((k % 2, ids, (np.ones(4) / 4).astype(np.float32)))
    got, bias = quality_classifier.train(samples, seed=5)

    rng = np.random.default_rng(5)
    dims = quality_classifier.DIMENSIONS
    vectors = rng.uniform(-1, 1, (12, dims)).astype(np.float32).astype(float)
    layer, offset = [[0.0, 0.0] for _ in range(dims)], [0.0, 0.0]
    for done, k in enumerate(rng.permutation(9)):
        label, ids, weights = samples[k]
        step = quality_classifier.STEP * (1 - done / 9)
        mean = [sum(w * vectors[i][d] for i, w in zip(ids, weights)) for d in range(dims)]
        logits = [sum(mean[d] * layer[d][c] for d in range(dims)) + offset[c] for c in (0, 1)]
        odds = [np.exp(x) for x in logits]
        error = [o / sum(odds) - (c == label) for c, o in enumerate(odds)]
        back = [sum(layer[d][c] * error[c] for c in (0, 1)) for d in range(dims)]
        for d in range(dims):
            for c in (0, 1):
                layer[d][c] -= step * mean[d] * error[c]
        for c in (0, 1):
            offset[c] -= 0.1 * step * error[c]
        for i, w in zip(ids, weights):
            for d in range(dims):
                vectors[i][d] -= 10 * step * w * back[d]
    want = [sum(vectors[i][d] * (layer[d][1] - layer[d][0]) for d in range(dims)) for i in range(12)]
    assert np.allclose(got, want, atol=1e-4) and abs(bias - (offset[1] - offset[0])) < 1e-5


def test_equal_texts_have_equal_scores(spark, labels):
    texts = ["a cat sat on the mat", "the the the", "Ünï cödé " * 40, "", "a cat sat on the mat " * 300]
    rows = [(i, texts[i % 5], None, None, None) for i in range(40)]
    scores = {}
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        for r in rows_of(quality_classifier.score_documents(df, labels)):
            scores.setdefault(texts[r["doc_id"] % 5], set()).add(r["score"])
    assert all(len(s) == 1 for s in scores.values()) and len(scores) == 5


# -- 10, disclosure against brute force ----------------------------------------------------------


def brute_disclosure(texts):
    """Largest disclosure per term over all (entity, term), counted text by text."""
    import math

    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    clean = lambda w: re.sub(r"^[\W_]+|[\W_]+$", "", w).lower()
    distinct = sorted(set(texts))
    with_e, where, n_t, n_et = {}, {}, Counter(), Counter()
    contexts = {}
    for text in distinct:
        words = WORD.findall(text)
        entities = {m.group().lower() for m in email.finditer(text)}
        bare = {clean(w) for w in words if not email.search(w)}
        bare = {t for t in bare if len(t) > 1}
        n_t.update(bare)
        for e in entities:
            around = []
            for m in email.finditer(text):
                if m.group().lower() == e:
                    around.append((re.sub(r"\S+$", "", text[: m.start()]), re.sub(r"^\S+", "", text[m.end() :])))
            with_e[e] = with_e.get(e, 0) + 1
            contexts.setdefault(e, {}).setdefault(tuple(sorted(set(around))), set()).update(bare)
            where.setdefault(e, set()).add(tuple(sorted(set(around))))
            n_et.update((e, t) for t in bare)
    best = {}
    for (e, t), both in n_et.items():
        held = sum(t in terms for terms in contexts[e].values())
        if len(where[e]) < pii.SUPPORT or held < pii.SUPPORT:
            continue
        own = max(-math.log2(with_e[e] / len(distinct)), 1)
        value = 1 + math.log2(min(1, both / n_t[t])) / own
        if value >= pii.GENERALISE:
            best[t] = max(best.get(t, 0), value)
    return best


@pytest.mark.parametrize("small", [True, False])
def test_disclosure_is_brute_force(spark, monkeypatch, small):
    """Over all pairs of entities and terms, with broadcast and with shuffled joins; copies weigh nothing."""
    if not small:
        monkeypatch.setattr(pii, "BROADCAST_BYTES", 0)
    rng = random.Random(4)
    people = [f"p{i}@mail.example" for i in range(6)]
    texts = []
    for i in range(160):
        words = [f"w{rng.randrange(12)}" for _ in range(6)] + [f"r{i}"]
        if i % 2:
            k = rng.randrange(6)
            words.insert(3, people[k])
            words += [f"Nick{k}"] if rng.random() < 0.8 else []
            words += [f"team{k // 2},"] if rng.random() < 0.9 else []
            words += ["Everyone"]
        texts.append(" ".join(words))
    texts += texts[:40]
    want = brute_disclosure(texts)
    assert any(t.startswith("nick") for t in want) and "everyone" not in want
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {}
    spanned = pii.find_spans(df).select("text", F.explode("terms").alias("t"))
    for r in spanned.collect():
        found[r.text[r.t.start : r.t.end].lower()] = r.t.disclosure
    assert set(found) == set(want) and all(abs(found[t] - want[t]) < 1e-9 for t in want)


def test_packing_holds_a_run_of_a_batch():
    import pyarrow as pa

    from tidepool.llm import packing

    texts = ["word and word " * 7000] * 8
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    out = list(packing._tokenize(None)(iter([batch])))
    assert max(len(set(x.column("doc_id").to_pylist())) for x in out) * len(texts[0]) <= packing.RUN_CHARS + len(texts[0])
    pieces = pa.Table.from_batches(out).to_pylist()
    assert [p["doc_id"] for p in pieces] == sorted(p["doc_id"] for p in pieces)
    for k in range(8):
        assert sum(p["length"] for p in pieces if p["doc_id"] == k) == pieces[0]["doc_tokens"]


def test_whole_rows_carry_their_text_once(spark):
    from tidepool.llm.common import row_and_text

    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert docs.select(*row_and_text(docs)).columns == ["doc"]
    numbers = docs.selectExpr("doc_id", "doc_id AS text")
    assert dict(numbers.select(*row_and_text(numbers)).dtypes)["text"] == "string"


def test_piece_table_stays_sorted():
    from tidepool.llm.wordtable import PieceTable

    table = PieceTable(100)
    for keys in ([5, 1, 9], [7, 2], [], [0, 10]):
        ids = [np.array([k, k + 1][: 1 + k % 2], "<u4").tobytes() for k in keys]
        table.add(np.array(keys, np.uint64), np.array(keys, np.uint64) * np.uint64(3), ids)
    assert table.key.tolist() == [0, 1, 2, 5, 7, 9, 10] and (table.check == table.key * np.uint64(3)).all()
    found = [table.ids[a : a + n].tolist() for a, n in zip(table.start, table.size)]
    assert found == [[k, k + 1][: 1 + k % 2] for k in table.key.tolist()]
