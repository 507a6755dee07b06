"""Importance resampling, decontamination and the filter audit against brute force and SQL."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from check_oracles import duck_connection, normalized
from tidepool.llm import decontaminate, filter_audit, importance, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
GRAM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASHES = ("hits", "items", "clean", "n_words", "rank", "score", "part", "mask", "digest", "good", "n", "c0")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977} Ünïcode" for i in range(20_000))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [
        (1, f"Before, {item.upper()}! after", "en", "s", 1),
        (2, "x" + item + "x tail of words here", "en", "s", 1),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \n\t ", None, "s", 3),
        (6, long + " " + item, "en", "s", 9),
        (7, "Kurz, gut", "de", "s", 7),
        (8, "kurz gut und mehr kurz. GUT", "de", "s", 7),
        (9, "日本語 テキスト é É", "de", "s", 7),
        (10, "a b " * 60 + "# END", "de", "s", 7),
        (11, "a b " * 60 + "# END", "de", "s", 7),
        (1, f"Before, {item.upper()}! after", "en", "s", 1),
        (None, f"no id {item}", "en", "s", 1),
        (None, "", "", "s", 1),
        (1, "another text under the same id kurz gut", "en", "s", 1),
        *((100 + i, " ".join(f"{chr(97 + (i * k) % 26)}{k}" for k in range(30 + i)), "en", "s", 1) for i in range(20)),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASHES:
        df = df.selectExpr("*", f"'x' as {name}")
    return df.selectExpr("*", "'dotted' as `a.b`")


@pytest.fixture(scope="module")
def bench(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, item), (2, "Kurz gut"), (3, None), (4, " ... "), (5, item[6:]), (None, "É"), (2, "tail of words"), (10, "kurz gut")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as hash", "2 as digest")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_decontamination", "op13_filter_audit"])
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.execute(queries.ORACLES[name])
    expected = normalized([d[0] for d in found.description], found.fetchall())
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == expected


# -- 11 -----------------------------------------------------------------------------------


def features(text):
    words = GRAM.findall(lower(text))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_resample(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for d in docs for f in features(d["text"])[1])
    t = Counter(bucket(f) for d in target for f in features(d["text"])[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
        for b in range(10_000)
    ]
    out = []
    for d in docs:
        words, own = features(d["text"])
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        name = "" if d["doc_id"] is None else d["doc_id"]
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d["doc_id"], len(own), weight, score, len(words)])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {}
    for rank, r in enumerate(able[: 25 * len(able) // 100], 1):
        drawn.setdefault(tuple(r), []).append(rank)
    return sorted((tuple(r[:4]) + ((drawn.get(tuple(r)) or [None]).pop(0) if drawn.get(tuple(r)) else None,) for r in out), key=repr)


def test_resampling_is_brute_force(edge, bench):
    out = rows_of(importance.resample(edge, bench))
    got = sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in out), key=repr)
    assert got == brute_resample(rows_of(edge), rows_of(bench))


def test_crc_of_joined_strings():
    rng = np.random.default_rng(1)
    parts = [rng.bytes(int(n)) for n in rng.integers(0, 300, 200)]
    crc = np.array([zlib.crc32(p) for p in parts], np.uint32)
    size = np.array([len(p) for p in parts])
    got = importance.joined_crc(crc[:-1], crc[1:], size[1:])
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_features_do_not_depend_on_the_batch(monkeypatch):
    texts = [b"A cat", b"", b"sat on", b"\xc3\x84 cat sat", b"the mat" * 50]
    whole = importance.Features()
    buckets, owner, words = whole.of(texts)
    monkeypatch.setattr(importance, "KNOWN_WORDS", 2)
    small = importance.Features()
    for i, text in enumerate(texts):
        alone, _, n = small.of([text])
        assert sorted(alone) == sorted(buckets[owner == i]) and n[0] == words[i]


def test_resampling_without_rows(empty, bench, edge):
    assert rows_of(importance.resample(empty, bench)) == []
    assert len(rows_of(importance.resample(edge, bench.where("false")))) == edge.count()


# -- 12 -----------------------------------------------------------------------------------


def brute_report(docs, items):
    windows = set()
    for it in items:
        words = GRAM.findall(lower(it["text"]))
        name = "" if it["item_id"] is None else str(it["item_id"])
        if words:
            size = min(len(words), 10)
            windows |= {(tuple(words[i : i + size]), name) for i in range(len(words) - size + 1)}
    by_window = {}
    for w, name in windows:
        by_window.setdefault(w, set()).add(name)
    out = []
    for d in docs:
        words = GRAM.findall(lower(d["text"]))
        hit, names = set(), set()
        for size in range(1, 11):
            for i in range(len(words) - size + 1):
                if found := by_window.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d["doc_id"], len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def reported(df):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in names) for r in rows_of(df)), key=repr)


def test_report_is_brute_force(edge, bench):
    assert reported(decontaminate.report(edge, bench)) == brute_report(rows_of(edge), rows_of(bench))


@pytest.mark.parametrize("most", [1, 3])
def test_a_larger_benchmark_takes_several_scans(edge, bench, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", most)
    assert reported(decontaminate.report(edge, bench)) == brute_report(rows_of(edge), rows_of(bench))
    cut = {r["doc_id"]: r["text"] for r in rows_of(decontaminate.remove(edge.where("doc_id in (7, 8)"), bench, whole=False))}
    assert cut == {7: "", 8: " und mehr "}


def test_hits_are_verified(edge, bench, monkeypatch):
    """With all hashes equal every window is a candidate; only true ones stay."""
    monkeypatch.setattr(decontaminate, "mix64", lambda x: x & np.uint64(0))
    text = rows_of(edge.where("doc_id in (1, 7, 8, 9)"))
    data = np.frombuffer("\n".join(r["text"] for r in text).encode(), np.uint8)
    words = decontaminate.Words(data, np.array([0, len(data)]))
    import pandas as pd

    known = decontaminate.Words(np.frombuffer(b"kurz gut", np.uint8), np.array([0, 8]))
    rows = pd.DataFrame({"length": [2], "hash": [0], "digest": [known.digest(0, 2)], "item": ["2"]})
    hits = list(decontaminate.Block.of(rows).hits(words))
    assert len(hits) == 4 and all(h[1:] == (2, ("2",)) for h in hits)


def test_spans_and_documents_are_removed(edge, bench):
    spans = rows_of(decontaminate.remove(edge, bench, whole=False))
    assert list(spans[0]) == edge.columns and len(spans) == edge.count()
    by_id = {}
    for r in spans:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    assert by_id[1].count("Before, ! after") == 2 and by_id[7] == [""] and by_id[3] == [None] and by_id[4] == [""]
    assert by_id[8] == [" und mehr "] and by_id[9] == ["日本語 テキスト é "]
    kept = rows_of(decontaminate.remove(edge, bench))
    assert list(kept[0]) == edge.columns and {3, 4, 5, 10, 11} <= {r["doc_id"] for r in kept}
    assert not {1, 6, 7, 8, 9} & {r["doc_id"] for r in kept if "another" not in (r["text"] or "")}


def test_decontamination_without_rows(edge, empty, bench):
    assert rows_of(decontaminate.report(empty, bench)) == []
    assert not any(r["contaminated"] for r in rows_of(decontaminate.report(edge, bench.where("false"))))


# -- 13 -----------------------------------------------------------------------------------


def brute_audit(docs, labels):
    space = re.compile(r"[^\x20\x09-\x0D]+")
    good = {r["doc_id"] for r in labels if r["quality"] == 1} - {None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1} - {None}
    first = {}
    for d in docs:
        if d["doc_id"] is not None:
            text = d["text"] or ""
            first[text] = min(first.get(text, d["doc_id"]), d["doc_id"])
    judged = []
    for d in docs:
        text = d["text"] or ""
        words = space.findall(text)
        failed = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        failed += "D" * bool(re.search("[#$%&*|]", text))
        failed += "E" * (d["doc_id"] is not None and d["doc_id"] > first[text])
        judged.append((d["lang"] or "", failed, d["doc_id"] in good, d["doc_id"] in toxic))
    out, total = [], Counter()
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                total[part, f] += len(gone)
                out.append([
                    part, order, step, len(left), len(gone), sum(f in j[1] for j in mine) - len(gone),
                    sum(j[1] == f for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone), f,
                ])
    return sorted((*r[:-1], total[r[0], r[-1]]) for r in out)


def test_audit_is_a_replay_of_all_orders(spark, edge):
    marks = [(1, 1, 0), (1, 0, 1), (7, None, 1), (8, 1, None), (10, 0, 0), (11, 1, 1), (None, 1, 1), (103, 1, 0), (4, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as good", "1 as n")
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    out = sorted(tuple(r[c] for c in names) for r in rows_of(filter_audit.audit(edge, labels)))
    assert out == brute_audit(rows_of(edge), rows_of(labels))


def test_audit_without_rows(empty, spark, edge):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows_of(filter_audit.audit(empty, none)) == []
    assert not any(r["good_lost"] or r["toxic_lost"] for r in rows_of(filter_audit.audit(edge, none)))
