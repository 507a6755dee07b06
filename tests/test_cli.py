from __future__ import annotations

import json

from tidepool.__main__ import main
from test_models import CUSTOMERS_CSV, EVENTS, ORDERS


def test_ingest_build_query(spark, tmp_path, capsys):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "customers.csv").write_text(CUSTOMERS_CSV, encoding="utf-8")
    (inbox / "events.json").write_text(json.dumps(EVENTS), encoding="utf-8")
    spark.createDataFrame(ORDERS, "order_id long, customer_id long, amount double, ordered_at string") \
        .coalesce(1).write.parquet(str(inbox / "orders.parquet"))
    spec = tmp_path / "sources.yml"
    spec.write_text(
        "version: 1\nsources:\n  - name: local_demo\n    type: filesystem\n    write_disposition: replace\n"
        f"    bucket_url: {inbox}\n    tables:\n"
        "      - {name: customers, file_glob: customers.csv, format: csv}\n"
        "      - {name: events, file_glob: events.json, format: json}\n"
        "      - {name: orders, file_glob: orders.parquet, format: parquet}\n",
        encoding="utf-8",
    )
    wh = str(tmp_path / "wh")
    assert main(["validate", str(spec)]) == 0
    assert main(["ingest", str(spec), "--warehouse", wh]) == 0
    assert main(["build", "--warehouse", wh]) == 0
    out = capsys.readouterr().out
    assert "raw_local_demo.orders replace rows=5" in out
    assert "unique customer_activity.customer_id failures=0" in out
    total = spark.sql("SELECT sum(lifetime_value) AS v FROM analytics.customer_activity").first().v
    assert str(total) == "1171.00"


def test_query_command(spark, tmp_path, capsys):
    path = tmp_path / "harbours.csv"
    path.write_text("harbour,depth,berths\nnorth,7.5,3\nsouth,12.25,8\neast,9.0,4\n", encoding="utf-8")
    sql = "select max_by(harbour, depth) as deepest, sum(berths) as berths from source"
    assert main(["query", str(path), "--sql", sql]) == 0
    out = capsys.readouterr().out
    assert "south" in out and "15" in out
