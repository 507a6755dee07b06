from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidepool.sources import jdbc
from tidepool.sources.objectstore import s3a_options, s3a_path
from tidepool.sources.registry import build_reader, read_source, supported_types
from tidepool.spec import InvalidSpec, SourceSpec


@pytest.mark.parametrize("kind", ["filesystem", "database", "api", "connector"])
def test_registry_knows_types(kind):
    assert callable(build_reader(SourceSpec(name="x", type=kind)))


def test_unknown_type_lists_supported():
    with pytest.raises(InvalidSpec, match="no reader for type ftp; there are api, connector, database, filesystem"):
        build_reader(SourceSpec(name="x", type="ftp"))
    assert supported_types() == ["api", "connector", "database", "filesystem"]


def test_filesystem_requires_bucket_and_tables(spark):
    with pytest.raises(InvalidSpec, match="bucket_url is missing"):
        read_source(spark, SourceSpec(name="x", type="filesystem", options={"tables": [{}]}))
    with pytest.raises(InvalidSpec, match="must not be empty"):
        read_source(spark, SourceSpec(name="x", type="filesystem", options={"bucket_url": "/tmp", "tables": []}))
    with pytest.raises(InvalidSpec, match="format must be one of"):
        read_source(
            spark,
            SourceSpec(
                name="x",
                type="filesystem",
                options={"bucket_url": "/tmp", "tables": [{"name": "t", "file_glob": "*.x", "format": "xml"}]},
            ),
        )


def test_database_reader_validation(spark, monkeypatch):
    monkeypatch.delenv("NO_SUCH_DB_URL", raising=False)
    base = {"engine": "postgresql", "credentials_env": "NO_SUCH_DB_URL", "table_names": ["orders"]}
    with pytest.raises(InvalidSpec, match="engine must be"):
        read_source(spark, SourceSpec(name="x", type="database", options={**base, "engine": "oracle"}))
    with pytest.raises(InvalidSpec, match="the environment has no NO_SUCH_DB_URL"):
        read_source(spark, SourceSpec(name="x", type="database", options=base))
    monkeypatch.setenv("NO_SUCH_DB_URL", "postgresql://u:p@h/db")
    with pytest.raises(InvalidSpec, match="table_names"):
        read_source(spark, SourceSpec(name="x", type="database", options={**base, "table_names": []}))


def test_jdbc_connection_from_url():
    conn = jdbc.jdbc_connection("postgresql", "postgresql://app:s%40cret@db.example:6543/shop")
    assert conn == {
        "url": "jdbc:postgresql://db.example:6543/shop",
        "driver": "org.postgresql.Driver",
        "user": "app",
        "password": "s@cret",
    }
    assert jdbc.jdbc_connection("mysql", "mysql://h/db")["url"] == "jdbc:mysql://h:3306/db"
    assert jdbc.qualified("orders", "public") == "public.orders"


def test_object_store_options():
    assert s3a_path("s3://b/k/*.parquet") == "s3a://b/k/*.parquet"
    opts = s3a_options(
        {
            "aws_access_key_id": "AK",
            "aws_secret_access_key": "SK",
            "endpoint_url": "http://minio:9000",
        }
    )
    assert opts == {
        "fs.s3a.access.key": "AK",
        "fs.s3a.secret.key": "SK",
        "fs.s3a.endpoint": "minio:9000",
        "fs.s3a.path.style.access": "true",
        "fs.s3a.connection.ssl.enabled": "false",
    }
    assert s3a_options({"aws_session_token": "T"})["fs.s3a.aws.credentials.provider"].endswith(
        "TemporaryAWSCredentialsProvider"
    )


class _FakeReader:
    def __init__(self, log):
        self.opts, self.log = {}, log

    def format(self, name):
        self.opts["format"] = name
        return self

    def option(self, key, value):
        self.opts[key] = value
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return self

    def first(self):
        return (10, 990)


class _FakeSpark:
    def __init__(self):
        self.log = []

        class _Ctx:
            defaultParallelism = 8

        self.sparkContext = _Ctx()

    @property
    def read(self):
        return _FakeReader(self.log)


def test_partitioned_jdbc_read_options():
    fake = _FakeSpark()
    conn = jdbc.jdbc_connection("postgresql", "postgresql://u:p@db/shop")
    jdbc.read_jdbc_table(fake, conn, "public.orders", chunk_size=1000, partition_column="order_id")
    bounds, table = fake.log
    assert "dbtable" not in bounds and bounds["query"].startswith("SELECT MIN(order_id)")
    assert "query" not in table
    assert (table["dbtable"], table["partitionColumn"], table["lowerBound"], table["upperBound"]) == (
        "public.orders", "order_id", "10", "990"
    )
    assert (table["numPartitions"], table["fetchsize"], table["url"]) == ("8", "1000", "jdbc:postgresql://db:5432/shop")
    jdbc.read_jdbc_table(fake, conn, "public.small")
    assert fake.log[-1]["dbtable"] == "public.small" and "partitionColumn" not in fake.log[-1]


# -- the database's catalogue and ranges of keys (no database is started) ---------------------


@pytest.fixture
def catalogue(monkeypatch):
    """A database whose catalogue and reads are recorded instead of asked."""
    monkeypatch.setenv("FAKE_DB_URL", "postgresql://u:p@h/db")
    kinds = {"orders": jdbc.TABLE, "recent": jdbc.VIEW, "log": jdbc.TABLE}
    reads = []
    monkeypatch.setattr(jdbc, "relation_types", lambda *a: {n: kinds[n] for n in a[-1] if n in kinds})
    monkeypatch.setattr(jdbc, "key_columns", lambda *a: ["id", "line"] if a[-1] == "orders" else [])
    monkeypatch.setattr(jdbc, "read_jdbc_ranges", lambda spark, c, engine, place, columns, *a: reads.append((place, columns)))
    monkeypatch.setattr(jdbc, "read_jdbc_table", lambda spark, c, place, *a: reads.append((place, *a[1:])))
    return reads


def database(names, **more):
    options = {"engine": "postgresql", "credentials_env": "FAKE_DB_URL", "schema": "shop", "table_names": names}
    return SourceSpec(name="x", type="database", options=options | more)


def test_views_need_the_flag(spark, catalogue):
    with pytest.raises(InvalidSpec, match="recent are views; set include_views"):
        read_source(spark, database(["orders", "recent"]))
    assert catalogue == []
    assert set(read_source(spark, database(["orders", "recent"], include_views=True))) == {"orders", "recent"}
    with pytest.raises(InvalidSpec, match="the database has no ghost"):
        read_source(spark, database(["orders", "ghost"], include_views=True))


def test_tables_are_cut_by_their_key(spark, catalogue):
    entries = ["orders", "recent", "log", {"name": "log", "primary_key": "code"}]
    read_source(spark, database(entries, include_views=True, partitioning={"recent": {"columns": ["day"]}}))
    read_source(spark, database(["log"], partitioning={"log": {"column": "n", "num_partitions": 3}}))
    assert catalogue == [
        ("shop.orders", ["id", "line"]),  # the key that the catalogue names
        ("shop.recent", ["day"]),
        ("shop.log",),  # no key: one task
        ("shop.log", ["code"]),
        ("shop.log", "n", 3),
    ]


def test_catalogue_queries(monkeypatch):
    asked = []
    rows = {"tables": [("a", "BASE TABLE")], "usage": [("line", 2), ("id", 1)]}
    monkeypatch.setattr(jdbc, "_query", lambda s, c, sql: asked.append(sql) or rows["usage" if "usage" in sql else "tables"])
    assert jdbc.relation_types(None, {}, "mysql", None, ["a", "it's"]) == {"a": "BASE TABLE"}
    assert "table_schema = DATABASE()" in asked[0] and "IN ('a', 'it''s')" in asked[0]
    assert jdbc.key_columns(None, {}, "postgresql", "shop", "t") == ["id", "line"]
    assert "table_schema = 'shop'" in asked[1]


@pytest.fixture(scope="module")
def keyed(spark):
    import datetime as dt

    rows = []
    for i in range(400):
        hot = i % 3 == 0  # a third of the rows share one key
        name = None if i % 41 == 0 else "its" if hot else f"n-{i % 50:02d}"
        at = None if i % 53 == 0 else dt.datetime(2026, 1, 1 + i % 28, i % 24, 30)
        rows.append((i, 7 if hot else i % 90, name, at, i % 7))
    df = spark.createDataFrame(rows, "id long, n int, name string, at timestamp_ntz, line int")
    df.createOrReplaceTempView("keyed_rows")
    return df


@pytest.mark.parametrize("columns", [["id"], ["n"], ["name"], ["at"], ["n", "line"], ["name", "at", "line"]])
@pytest.mark.parametrize("parts", [1, 9])
def test_ranges_hold_every_row_once(spark, keyed, columns, parts):
    bounds = [tuple(r) for r in spark.sql(jdbc.quantile_query("keyed_rows", columns, parts)).collect()]
    assert len(bounds) <= parts and bounds == sorted(bounds)
    predicates = jdbc.range_predicates(columns, bounds, "postgresql")
    ranges = [F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]
    placed = keyed.select("id", F.array_compact(F.array(*ranges)).alias("ranges")).collect()
    assert all(len(r.ranges) == 1 for r in placed) and len(placed) == 400
    if columns == ["id"]:
        sizes = [sum(r.ranges[0] == i for r in placed) for i in range(len(predicates))]
        assert max(sizes) <= 400 // parts + parts


def test_ranges_without_rows_and_literals():
    assert jdbc.range_predicates(["id"], [], "mysql") == ["1 = 1"]
    quote, back = chr(39), chr(92)
    last = jdbc.range_predicates(["id"], [("a",), ("b" + back + quote,)], "mysql")[1]
    assert last.endswith(f"id >= {quote}b{back}{back}{quote}{quote}{quote}")
    with pytest.raises(TypeError, match="no ranges"):
        jdbc.range_predicates(["id"], [(b"a",), (b"b",)], "mysql")


# -- connectors ---------------------------------------------------------------------------


def pages(folder, numbers, payload=None):
    import json

    folder.mkdir(exist_ok=True)
    for n in numbers:
        page = {"data": {"items": [{"id": 10 * n + k} for k in range(3)]}}
        (folder / f"page-{n:03d}.json").write_text(json.dumps(payload or page, indent=1))


def connector(path, **table):
    entry = {"name": "t", "options": {"path": str(path), "partition_bytes": 100}, "schema": "id bigint"} | table
    options = {"connector": "tidepool.sources.landed_pages:LandedPages", "options": {"records_path": "data.items"}}
    return SourceSpec(name="x", type="connector", options=options | {"tables": [entry]})


def test_connector_of_a_spec_is_read_by_its_format(spark, tmp_path):
    pages(tmp_path / "in", range(5))
    df = read_source(spark, connector(tmp_path / "in"))["t"].df
    assert sorted((r.id, r._page, r._page_pos) for r in df.collect()) == [
        (10 * n + k, n, k) for n in range(5) for k in range(3)
    ]
    assert df.rdd.getNumPartitions() > 1
    raw = spark.read.format("landed_pages").option("path", f"file:{tmp_path}/in").load()
    assert raw.columns == ["_page", "_page_pos", "record"] and raw.count() == 5


@pytest.mark.parametrize("payload", [{"data": {}}, {"data": {"items": [1]}}])
def test_pages_of_another_shape_stop_the_read(spark, tmp_path, payload):
    pages(tmp_path / "in", [1], payload)
    with pytest.raises(Exception, match="lacks the records_path|not objects"):
        read_source(spark, connector(tmp_path / "in"))["t"].df.collect()


def test_unknown_connectors_are_refused(spark):
    for name in ("no.such.module:X", "tidepool.sources.landed_pages:Nothing", "bare"):
        options = {"connector": name, "tables": [{"name": "t"}]}
        with pytest.raises(InvalidSpec, match="no connector"):
            read_source(spark, SourceSpec(name="x", type="connector", options=options))


def test_connector_as_a_stream_reads_pages_once(spark, tmp_path):
    from tidepool.sources.landed_pages import LandedPages

    spark.dataSource.register(LandedPages)
    out = []

    def run():
        stream = spark.readStream.format("landed_pages").options(path=str(tmp_path / "in"), records_path="data.items")
        query = (
            stream.load().writeStream.option("checkpointLocation", str(tmp_path / "ckpt"))
            .foreachBatch(lambda df, _: out.extend(sorted(r._page for r in df.collect())))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    pages(tmp_path / "in", [1, 2])
    run()
    assert out == [1, 1, 1, 2, 2, 2]
    pages(tmp_path / "in", [3])
    run()
    run()
    assert out[6:] == [3, 3, 3]
