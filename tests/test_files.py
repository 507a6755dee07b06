from __future__ import annotations

import re

import pytest

from tidepool.sources.files import glob_to_regex, infer_format, read_files, select_files


@pytest.fixture
def nested(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for rel, i in [("e0.jsonl", 0), ("a/e1.jsonl", 1), ("a/b/e2.jsonl", 2), ("a/b/skip.txt", 9)]:
        (tmp_path / rel).write_text(f'{{"id": {i}}}\n', encoding="utf-8")
    return tmp_path


@pytest.mark.parametrize(
    "glob, expected",
    [
        ("**/*.jsonl", [0, 1, 2]),
        ("a/**/*.jsonl", [1, 2]),
        ("**/b/*.jsonl", [2]),
        ("*.jsonl", [0]),
        ("*/*.jsonl", [1]),
        ("a/b/e{1,2}.jsonl", [2]),
    ],
)
def test_glob_depths(spark, nested, glob, expected):
    df = read_files(spark, f"{nested}/{glob}", "jsonl")
    assert sorted(r.id for r in df.collect()) == expected


def test_glob_to_regex():
    rx = re.compile("^" + glob_to_regex("events/**/*.jsonl") + "$")
    assert rx.match("events/x.jsonl") and rx.match("events/a/b/x.jsonl")
    assert not rx.match("events/x.json")
    assert select_files("/d/*.csv").options == {}
    sel = select_files("/d/**/*.csv")
    assert sel.path == "/d" and sel.options["pathGlobFilter"] == "*.csv" and sel.path_regex is None


@pytest.mark.parametrize(
    "path, fmt",
    [
        ("x.CSV", "csv"),
        ("x.csv.gz", "csv"),
        ("x.json?versionId=3", "json"),
        ("x.ndjson", "json"),
        ("d/x.json.gz", "json"),
        ("d/part-?.csv", "csv"),
        ("x.jsonl", "json"),
        ("x.parquet", "parquet"),
        ("dir/*", "parquet"),
    ],
)
def test_infer_format(path, fmt):
    assert infer_format(path) == fmt


def test_infer_format_rejects_unknown():
    with pytest.raises(ValueError, match="No reader for"):
        infer_format("data.xlsx")


def test_csv_inference_and_gzip(spark, tmp_path):
    import gzip

    (tmp_path / "c.csv").write_text("id,name,created_at\n1,Ada,2026-07-01T09:00:00Z\n", encoding="utf-8")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as fh:
        fh.write("id,name,created_at\n2,Grace,2026-07-03T11:30:00Z\n")
    df = read_files(spark, f"{tmp_path}/*.csv*", "csv")
    types = dict(df.dtypes)
    assert types["created_at"] == "timestamp_ntz" and types["id"] == "int"
    assert sorted(r.id for r in df.collect()) == [1, 2]


def test_parquet_files_with_added_column(spark, tmp_path):
    spark.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "p" / "a"))
    spark.createDataFrame([(2, "x")], "id long, note string").write.parquet(str(tmp_path / "p" / "b"))
    df = read_files(spark, f"{tmp_path}/p/**/*.parquet", "parquet")
    assert sorted((r.id, r.note) for r in df.collect()) == [(1, None), (2, "x")]


def test_csv_with_reordered_header_fails_closed(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("id,name\n1,Ada\n", encoding="utf-8")
    (tmp_path / "c" / "b.csv").write_text("name,id\nGrace,2\n", encoding="utf-8")
    df = read_files(spark, f"{tmp_path}/c/*.csv", "csv")
    with pytest.raises(Exception, match="(?i)header|schema"):
        df.collect()
