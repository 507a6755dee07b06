"""The tables' logs: growth, rebuilt states, conflicts, compaction, file-level merges."""

from __future__ import annotations

import json
import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.operators.incremental import load_incremental, pending_rows
from tidepool.operators.load import LoadError, Warehouse, bucket_of, key_hash
from tidepool.operators.tablelog import TableLog

SCHEMA = StructType([StructField("id", LongType())])


def entry(added, removed=(), **more):
    fields = {
        "dataset": "ds", "table_name": "t", "disposition": "append", "version_path": "/v", "reset": False,
        "table_schema": SCHEMA.json(), "primary_key": None, "buckets": None, "cursor_column": None,
        "cursor_max": None, "added": added, "removed": list(removed),
    }
    return fields | more


def size(path) -> int:
    return sum(e.stat().st_size for e in os.scandir(path) if not e.name.endswith(".crc"))


def test_thousand_appends_are_linear_and_quick_to_replay(spark, tmp_path):
    log, path = TableLog(spark, str(tmp_path), "ds", "t"), tmp_path / "_log" / "ds" / "t"
    state, sizes, written = None, {}, []
    write = log._write
    log._write = lambda name, text: (written.append(len(text)), write(name, text))
    for n in range(1, 1001):
        assert log.commit(state, entry([[f"_load=l-{n}/part-0.parquet", 100, 10]]))
        state = log.state()
        if n in (250, 500, 1000):
            sizes[n] = (size(path), sum(written))
    for n in (250, 500):  # what is kept, and what was written in all, follow the number of loads
        assert all(b < 2.6 * a for a, b in zip(sizes[n], sizes[2 * n]))
    fresh = TableLog(spark, str(tmp_path), "ds", "t")
    reads = []
    text = fresh._text
    fresh._text = lambda name: (reads.append(name), text(name))[1]
    assert len(fresh.state().files) == 1000 and len(fresh.names()) < 130 and len(reads) < 110
    for n in (1, 19, 20, 21, 99, 100, 101, 500, 999):
        assert set(fresh.state(n).files) == {f"_load=l-{k}/part-0.parquet" for k in range(1, n + 1)}
    assert fresh.state(1001) is None


def test_states_after_removals_and_resets(spark, tmp_path):
    log = TableLog(spark, str(tmp_path), "ds", "t", snapshot_every=3, fold=4)
    f = lambda n: [f"_load=l-{n}/part-0.parquet", 100, 10]
    steps = [
        (entry([f(1)]), {1}),
        (entry([f(2), f(3)]), {1, 2, 3}),
        (entry([f(4)], [f(1)[0], f(3)[0]]), {2, 4}),
        (entry([f(5)], reset=True), {5}),
        (entry([f(6)], reset=True, version_path="/v2"), {6}),
        (entry([f(7)], version_path="/v2", stream="s", batch=4), {6, 7}),
        (entry([], disposition="vacuum", keep=2, version_path="/v2"), {6, 7}),
        (entry([], [f(6)[0]], version_path="/v2"), {7}),
    ]
    for e, _ in steps:
        assert log.commit(log.state(), e)
    for n, (_, live) in enumerate(steps, 1):
        for reader in (log, TableLog(spark, str(tmp_path), "ds", "t")):
            assert {int(x.load_id) for x in reader.state(n).files.values()} == live
    last = TableLog(spark, str(tmp_path), "ds", "t").state()
    assert last.batches == {"s": 4} and last.version_path == "/v2"
    assert last.versions == [(5, "/v")] and last.dead == [(8, f"/v2/{f(6)[0]}")]


def test_cut_snapshot_and_half_finished_fold_do_no_harm(spark, tmp_path):
    log = TableLog(spark, str(tmp_path), "ds", "t", snapshot_every=2, fold=100)
    for n in range(7):
        log.commit(log.state(), entry([[f"_load=l-{n}/p", 1, 1]]))
    folder = tmp_path / "_log" / "ds" / "t"
    newest = sorted(p.name for p in folder.iterdir() if p.name.startswith("s-"))[-1]
    (folder / newest).write_text('{"dataset": "ds", "tab')
    (folder / f".{newest}.crc").unlink(missing_ok=True)
    keep = log._delete
    log._delete = lambda name: None if name[0] == "e" else keep(name)  # the driver is lost before
    assert log.fold() == 7
    assert any(n[0] == "f" for n in log.names()) and sum(n[0] == "e" for n in log.names()) == 7
    again = TableLog(spark, str(tmp_path), "ds", "t")
    assert len(again.state().files) == 7 and len(again.state(4).files) == 4
    assert again.commit(again.state(), entry([["_load=l-8/p", 1, 1]])) and len(again.state().files) == 8


def test_a_load_on_a_state_long_folded_fails(spark, tmp_path):
    slow, log = (TableLog(spark, str(tmp_path), "ds", "t", fold=4) for _ in range(2))
    log.commit(log.state(), entry([["_load=l-0/p", 1, 1]]))
    base = slow.state()
    for n in range(1, 9):
        log.commit(log.state(), entry([[f"_load=l-{n}/p", 1, 1]]))
    assert "e-000000000002.json" not in log.names()
    assert not slow.commit(base, entry([["_load=l-late/p", 1, 1]]))
    assert len(slow.state().files) == 9 and "e-000000000002.json" not in log.names()


def test_of_many_writers_one_commits(spark, tmp_path):
    logs = [TableLog(spark, str(tmp_path), "ds", "t") for _ in range(6)]
    base = logs[0].state()
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda i: logs[i].commit(base, entry([[f"_load=l-{i}/p", 1, 1]])), range(6)))
    assert sum(done) == 1
    assert [f.load_id for f in logs[3].state().files.values()] == [str(done.index(True))]
    assert [p for p in os.listdir(tmp_path / "_log" / "ds" / "t") if "tmp" in p and not p.endswith(".crc")] == []


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_small_batch_rewrites_few_files(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2, file_rows=500)
    base = spark.range(20_000).select("id", F.lit("old").alias("v"))
    wh.load(base, "ds", "t", "merge", primary_key=["id"])
    before = wh.state("ds", "t")
    assert len(before.files) >= 40 and not before.partial_folders()
    for f in list(before.files.values())[::15]:  # the log's ranges are true
        found = spark.read.parquet(f"{before.version_path}/{f.path}").agg(
            F.count("*"), F.min(key_hash(("id",))), F.max(key_hash(("id",)))).first()
        assert tuple(found) == (f.rows, f.low, f.high)
    batch = spark.range(19_995, 20_005).select("id", F.lit("new").alias("v"))
    load = wh.load(batch, "ds", "t", "merge")
    told = wh.audit().where(F.col("load_id") == load.load_id).first()
    assert told.files_read == told.files_removed <= 10 and told.files_added <= 12
    assert told.files_live == len(wh.state("ds", "t").files)
    assert rows(wh.read("ds", "t")) == [(i, "old") for i in range(19_995)] + [(i, "new") for i in range(19_995, 20_005)]
    assert rows(wh.read("ds", "t", load_seq=1)) == [(i, "old") for i in range(20_000)]
    assert wh.state("ds", "t").partial_folders()
    some = spark.range(5).select("id", F.lit("no").alias("v"))
    assert wh.load(some, "ds", "t", "insert_ignore").rows_loaded == 0
    wh.load(some, "ds", "t", "delete_insert", delete_keys=spark.range(100, 103))
    left = dict(rows(wh.read("ds", "t")))
    assert len(left) == 20_002 and left[0] == "no" and 101 not in left and left[103] == "old"


def test_untouched_files_are_not_read(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2, file_rows=100)
    wh.load(spark.range(2000).select("id", F.lit(1).alias("n")), "ds", "t", "merge", primary_key=["id"])
    st = wh.state("ds", "t")
    [key] = spark.range(7, 8).select(key_hash(("id",)), bucket_of(("id",), 2)).collect()
    for f in st.files.values():
        if not (f.bucket == key[1] and f.low <= key[0] <= f.high):
            path = f"{st.version_path}/{f.path}"
            with open(path, "wb") as fh:
                fh.write(b"not parquet")
            os.remove(f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc")
    assert wh.load(spark.range(7, 8).select("id", F.lit(2).alias("n")), "ds", "t", "merge").rows_loaded == 1


@pytest.mark.parametrize("keyed", [False, True])
def test_compaction_keeps_rows_and_old_states(spark, tmp_path, keyed):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2 if keyed else None)
    for n in range(6):
        extra = {"w": F.lit(n)} if n > 2 else {}
        batch = spark.range(n * 10, n * 10 + 10).select("id", F.lit(n).alias("v")).withColumns(extra)
        wh.load(batch, "ds", "t", "append", primary_key=["id"] if keyed else None)
    want = rows(wh.read("ds", "t"))
    result = wh.compact("ds", "t")
    assert (result.rows_loaded, rows(wh.read("ds", "t"))) == (60, want)
    assert len(wh.state("ds", "t").files) == (2 if keyed else 1)
    assert rows(wh.read("ds", "t", load_seq=2).select("id")) == [(i,) for i in range(20)]
    assert wh.compact("ds", "t") is None  # nothing small is left to join
    wh.load(spark.range(60, 65).select("id"), "ds", "t", "append")
    assert wh.read("ds", "t").count() == 65
    assert wh.vacuum("ds", "t", keep=1) and wh.read("ds", "t").count() == 65
    with pytest.raises(LoadError, match="vacuumed"):
        wh.read("ds", "t", load_seq=2)


def test_compaction_respects_the_target_size(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for n in range(8):
        wh.load(spark.range(n * 1000, n * 1000 + 1000).coalesce(1), "ds", "t")
    one = next(iter(wh.state("ds", "t").files.values())).bytes
    wh.compact("ds", "t", file_bytes=one * 4 + 100)
    files = wh.state("ds", "t").files.values()
    assert 2 <= len(files) <= 3 and sum(f.rows for f in files) == 8000


def test_compaction_that_meets_a_load_gives_way(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(3):
        wh.load(spark.range(5), "ds", "t")

    class Slow(Warehouse):
        def _record(self, *args, **fields):
            wh.load(spark.range(2), "ds", "t")
            super()._record(*args, **fields)

    with pytest.raises(LoadError, match="changed while"):
        Slow(spark, wh.root).compact("ds", "t")
    assert wh.read("ds", "t").count() == 17


def test_catalog_entry_of_a_table_with_partly_superseded_folders(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2, file_rows=20, catalog=True)
    wh.load(spark.range(200).select("id", F.lit(1).alias("n")), "log_cat", "t", "merge", primary_key=["id"])
    wh.load(spark.range(3).select("id", F.lit(2).alias("n")), "log_cat", "t", "merge")
    assert tuple(spark.sql("SELECT count(*), sum(n) FROM log_cat.t").first()) == (200, 203)
    assert not wh.state("log_cat", "t").partial_folders()


def test_cursor_is_pushed_into_the_scan(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    spark.range(1000).select("id", F.col("id").alias("c")).write.parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src"))
    for key in ([], ["id"]):
        load_incremental(source.where("c < 500"), wh, "ds", f"t{len(key)}", "c", key)
        plan = pending_rows(source, wh, "ds", f"t{len(key)}", "c", key)._jdf.queryExecution().executedPlan().toString()
        assert "Or(IsNull(c),GreaterThanOrEqual(c,499))" in plan
        assert load_incremental(source, wh, "ds", f"t{len(key)}", "c", key).rows_loaded == 500
    bad = source.unionByName(spark.createDataFrame([(1, None)], "id long, c long"))
    with pytest.raises(Exception, match="NULL cursor"):
        load_incremental(bad, wh, "ds", "t1", "c", ["id"])
    with pytest.raises(Exception, match="NULL cursor"):
        load_incremental(bad, wh, "ds", "first", "c")


def test_audit_reads_all_logs(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for table in ("a", "b"):
        for _ in range(3):
            wh.load(spark.range(4), "ds", table)
    wh.compact_audit()
    wh.load(spark.range(4), "ds", "a")
    got = rows(wh.audit().select("table_name", "load_seq", "rows_loaded", "files_added"))
    assert [g[:3] for g in got] == [("a", 1, 4), ("a", 2, 4), ("a", 3, 4), ("a", 4, 4), ("b", 1, 4), ("b", 2, 4), ("b", 3, 4)]
    assert json.loads(wh.audit().first().table_schema)["type"] == "struct"


@pytest.mark.parametrize("disposition", ["merge", "insert_ignore", "delete_insert"])
def test_large_buckets_are_written_by_several_tasks(spark, tmp_path, monkeypatch, disposition):
    def states(root):
        wh = Warehouse(spark, str(tmp_path / root), buckets=2, file_rows=300)
        rows = spark.range(4000).select("id", F.lit("old").alias("v"))
        wh.load(rows, "ds", "t", "append", primary_key=["id"])
        wh.load(rows.where("id % 7 = 0").union(spark.createDataFrame([(None, "x")], "id long, v string")), "ds", "t", "append")
        gone = spark.range(3000, 3100) if disposition == "delete_insert" else None
        batch = spark.range(2000, 5000).select("id", F.lit("new").alias("v"))
        wh.capture_plans = True
        wh.load(batch, "ds", "t", disposition, delete_keys=gone)
        plan = dict(wh.plans)[{"merge": "merge buckets", "insert_ignore": "insert buckets"}.get(disposition, "delete-insert buckets")]
        return wh, wh.state("ds", "t"), plan

    one, before, _ = states("one")
    monkeypatch.setattr("tidepool.operators.load.TASK_ROWS", 500)
    many, after, plan = states("many")
    for n in (1, 2, 3):
        assert rows(one.read("ds", "t", n).na.fill(-1)) == rows(many.read("ds", "t", n).na.fill(-1))
    # each load's tasks: the number in a part file's name; ranges of files of a bucket do not overlap
    by_load = {}
    for f in after.files.values():
        by_load.setdefault((f.load_id, f.bucket), []).append(f)
    assert max(len({f.path.rpartition("part-")[2][:5] for f in own}) for own in by_load.values()) >= 4
    for own in by_load.values():
        own = sorted(own, key=lambda f: f.low)
        assert disposition != "merge" or all(a.high <= b.low for a, b in zip(own, own[1:]))
    assert len({f.path.rpartition("part-")[2][:5] for f in before.files.values()}) <= 6
    exchanges = re.findall(r"\) Exchange\n.*\nArguments: (\w+)", plan)  # one a side, whether or not one is broadcast
    assert set(exchanges) == {"shufflepartitionidpassthrough"} and len(exchanges) >= 2
    many.compact("ds", "t", file_bytes=1 << 30)
    assert rows(one.read("ds", "t").na.fill(-1)) == rows(many.read("ds", "t").na.fill(-1))


def test_a_task_writes_a_bounded_number_of_files():
    from tidepool.operators.load import TASK_FILES, slices_of

    for rows in (900_000, 54_000_000):
        assert slices_of(4, 0, rows, 200) * 4 * TASK_FILES * 200 >= rows
    assert slices_of(4, 0, 1000, 200) == 1


def test_whole_folders_are_read_around_superseded_files(spark, tmp_path):
    from tidepool.operators.load import DEAD_NAMES

    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=4, file_rows=50)
    wh.load(spark.range(2000).selectExpr("id AS k", "1 AS v"), "raw", "t", "merge", primary_key=["k"])
    wh.load(spark.range(2).selectExpr("id AS k", "2 AS v"), "raw", "t", "merge")
    wh.load(spark.range(1, 3).selectExpr("id AS k", "3 AS v"), "raw", "t", "merge")
    st = wh.state("raw", "t")
    paths, dead = st.paths(None, DEAD_NAMES)
    assert dead and st.partial_folders() and len(paths) < len(st.files) // 2
    assert not st.paths()[1] and len(st.paths()[0]) > len(paths)
    rows = {r.k: r.v for r in wh.read("raw", "t").collect()}
    assert wh.read("raw", "t").count() == 2000 and rows == {k: {0: 2, 1: 3, 2: 3}.get(k, 1) for k in range(2000)}
    before = wh.read("raw", "t", load_seq=2).where("v = 2")
    assert sorted(r.k for r in before.collect()) == [0, 1]
    wh.vacuum("raw", "t", keep=1)
    assert wh.read("raw", "t").count() == 2000


def log_replay(spark, tmp_path, monkeypatch, rows):
    """``load_log_replay`` over ``rows`` as orders: its result and its warehouse."""
    from tidepool.plans import scenarios

    made = []

    class Kept(Warehouse):
        def __init__(self, *args, **settings):
            super().__init__(*args, **settings)
            made.append(self)

    monkeypatch.setattr(scenarios, "Warehouse", Kept)
    orders = rows.selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "id + 0.25D AS o_totalprice", "TIMESTAMP_NTZ'2026-01-01' AS o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    result = scenarios.q_load_log_replay(spark, str(tmp_path))
    return sorted(tuple(r) for r in result.select("load_seq", "n", "order_ids", "cents").collect()), made[0]


def replayed(ids):
    out = []
    for n in range(1, 10):
        live = [i for i in ids if (i % 6 < n if n < 9 else i % 3 == 0)]
        amounts = [100 * i + 25 + 100 * (n in (7, 8) and i % 2 == 0) for i in live]
        out += [(n, len(live), sum(live), sum(amounts))] if live else []
    return out


def test_log_replay_compacts_between_its_merge_and_its_replace(spark, tmp_path, monkeypatch):
    got, wh = log_replay(spark, tmp_path, monkeypatch, spark.range(600))
    assert got == replayed(range(600))
    told = sorted(wh.audit().collect(), key=lambda e: e.load_seq)
    assert [e.disposition for e in told] == [*["append"] * 6, "merge", "compact", "replace"]
    compaction = told[7]
    assert compaction.rows_loaded == 600 and compaction.files_read == compaction.files_removed == told[6].files_live
    assert compaction.files_added == compaction.files_live == 2 < told[6].files_live  # one file a bucket
    assert rows(wh.read("raw", "orders", 7)) == rows(wh.read("raw", "orders", 8)) and wh.read("raw", "orders", 8).count() == 600
    assert not set(wh.state("raw", "orders", 7).files) & set(wh.state("raw", "orders", 8).files)


@pytest.mark.parametrize("ids", [[], [0], [0, 0, 6], [1, 2, 3]])
def test_log_replay_of_a_table_with_little_to_compact(spark, tmp_path, monkeypatch, ids):
    got, _ = log_replay(spark, tmp_path, monkeypatch, spark.createDataFrame([(i,) for i in ids], "id long"))
    assert got == replayed(ids)


def test_append_of_no_rows_is_a_load_of_its_own(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets=2)
    wh.load(spark.range(20), "ds", "t", "append", primary_key=["id"])
    before = wh.state("ds", "t")
    assert wh.load(spark.range(20).limit(0), "ds", "t", "append").rows_loaded == 0
    after = wh.state("ds", "t")
    assert (after.load_seq, after.files) == (2, before.files) and wh.read("ds", "t", load_seq=1).count() == 20
