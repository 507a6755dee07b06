from __future__ import annotations

import json

import pytest

from tidepool.sources.documents import DocumentError, read_json_documents


def _docs(tmp_path, **files):
    # pretty-printed: a document spans many lines
    for name, payload in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(payload, indent=2), encoding="utf-8")
    return str(tmp_path / "*.json")


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_every_object_of_an_array_is_a_record(spark, tmp_path):
    boats = [{"id": n, "name": f"boat {n}"} for n in (40, 41, 42)]
    assert _ids(read_json_documents(spark, _docs(tmp_path, fleet=boats))) == [40, 41, 42]


def test_records_below_a_dotted_path(spark, tmp_path):
    harbour = {"meta": {"port": "K"}, "quay": {"east": {"berths": [{"id": 8}, {"id": 9}]}}}
    assert _ids(read_json_documents(spark, _docs(tmp_path, h=harbour), "quay.east.berths")) == [8, 9]


def test_arrays_hold_objects_only(spark, tmp_path):
    with pytest.raises(DocumentError, match="arrays must contain objects"):
        read_json_documents(spark, _docs(tmp_path, mixed=[{"id": 1}, "loose", None]))


def test_values_that_do_not_fit_the_schema_stop_the_read(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED_RECORD|CANNOT_PARSE|BAD_RECORD|malformed"):
        read_json_documents(spark, _docs(tmp_path, a=[{"id": "abc"}]), schema="id bigint").collect()


def test_single_object_is_one_record(spark, tmp_path):
    assert _ids(read_json_documents(spark, _docs(tmp_path, one={"id": 7, "x": "y"}))) == [7]


def test_mixed_object_and_array_files_and_empty_array(spark, tmp_path):
    path = _docs(tmp_path, a=[{"id": 1}, {"id": 2}], b={"id": 3}, c=[])
    assert _ids(read_json_documents(spark, path)) == [1, 2, 3]


def test_missing_path_in_one_of_several_files(spark, tmp_path):
    path = _docs(tmp_path, a={"data": {"items": [{"id": 1}]}}, b={"data": {"other": []}})
    with pytest.raises(DocumentError, match="lacks the records_path data.items"):
        read_json_documents(spark, path, "data.items")


def test_scalar_root_rejected(spark, tmp_path):
    with pytest.raises(DocumentError, match="neither an object nor an array"):
        read_json_documents(spark, _docs(tmp_path, s="text"))


def test_explicit_schema_skips_inference(spark, tmp_path):
    df = read_json_documents(spark, _docs(tmp_path, a=[{"id": 1, "v": "x"}]), schema="id bigint")
    assert df.columns == ["id"] and _ids(df) == [1]


def test_iso_timestamps_become_utc_ntz(spark, tmp_path):
    path = _docs(tmp_path, e=[{"id": 1, "at": "2026-08-01T10:05:00Z"}, {"id": 2, "at": "2026-08-01T12:05:00+02:00"}])
    rows = read_json_documents(spark, path).orderBy("id").collect()
    assert [str(r.at) for r in rows] == ["2026-08-01 10:05:00", "2026-08-01 10:05:00"]


def test_single_line_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]), encoding="utf-8")
    assert _ids(read_json_documents(spark, str(tmp_path / "a.json"))) == [1, 2]


@pytest.mark.parametrize("payload", [[{"id": 1}, None], [{"id": 1}, [{"id": 2}]], [{"id": 1}, "x"]])
def test_non_object_elements_rejected(spark, tmp_path, payload):
    with pytest.raises(DocumentError, match="arrays must contain objects"):
        read_json_documents(spark, _docs(tmp_path, bad=payload))


def test_api_pages_keep_page_and_position(spark, tmp_path):
    from tidepool.sources.api_pages import read_resource

    res = tmp_path / "landing" / "posts"
    res.mkdir(parents=True)
    for page, ids in [(1, [10, 11]), (2, [12])]:
        doc = {"page": page, "data": {"items": [{"id": i} for i in ids]}}
        (res / f"page-{page}.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    df = read_resource(spark, str(tmp_path / "landing"), "posts", data_selector="data.items")
    assert sorted((r.id, r._page, r._page_pos) for r in df.collect()) == [(10, 1, 0), (11, 1, 1), (12, 2, 0)]


def test_inferred_columns_are_those_of_json_lines(spark, tmp_path):
    """One parse gives the types that the JSON Lines reader infers from the same records."""
    from tidepool.sources.files import read_files

    records = [
        {"id": 1, "price": 2.5, "ok": True, "at": "2026-08-01T10:05:00", "day": "2026-08-01", "mixed": 1, "none": None,
         "zoned": "2026-08-01T10:05:00Z", "name": "x", "code": "0012", "tags": ["a", "b"], "empty": [],
         "deep": {"a b": {"when": "2026-01-02 03:04:05", "n": 1}}, "rows": [{"t": "2026-01-01T00:00:00", "v": 1.5}]},
        {"id": 20000000000, "price": 3, "ok": False, "at": None, "day": "2026-08-02", "mixed": "two",
         "zoned": "2026-08-01T10:05:00+02:00", "name": "2026-08-01", "tags": [], "extra": [[1], [2, 3]],
         "deep": {"a b": {"when": "2026-01-02 03:04:05.5"}, "more": "m"}, "rows": [{"t": None, "v": 2, "w": "z"}]},
    ]
    path = _docs(tmp_path, a=records[:1], b=records[1:])
    (tmp_path / "lines.jsonl").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    got, want = read_json_documents(spark, path), read_files(spark, str(tmp_path / "lines.jsonl"), "jsonl")
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in want.schema}
    key = lambda df: [r.asDict(True) for r in df.orderBy("id").collect()]
    assert key(got) == key(want)


def test_ingestion_deletes_what_it_staged(spark, tmp_path):
    from tidepool.operators.load import Warehouse
    from tidepool.plans.ingest import ingest
    from tidepool.sources.registry import read_source
    from tidepool.spec import parse_source_specs

    _docs(tmp_path, a=[{"id": 1}, {"id": 2}])
    table = {"name": "t", "file_glob": "*.json", "format": "json"}
    [spec] = parse_source_specs({"version": 1, "sources": [
        {"name": "d", "type": "filesystem", "bucket_url": str(tmp_path), "tables": [table]}]})
    staged = []
    import tidepool.plans.ingest as module

    def watched(spark, spec):
        tables = read_source(spark, spec)
        staged.extend(t.staging for t in tables.values())
        return tables

    original, module.read_source = module.read_source, watched
    try:
        wh = Warehouse(spark, str(tmp_path / "wh"))
        ingest(spark, spec, wh)
    finally:
        module.read_source = original
    assert wh.read("raw_d", "t").count() == 2
    [place] = staged
    fs = spark._jvm.org.apache.hadoop.fs.Path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(place))
