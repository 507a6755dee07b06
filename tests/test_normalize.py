from __future__ import annotations

import pytest

from tidepool.operators.normalize import (
    NameCollisionError,
    child_table,
    flatten,
    normalize_names,
    parse_json_column,
    snake_case,
)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("CustomerName", "customer_name"),
        ("customer name", "customer_name"),
        ("Customer-Name", "customer_name"),
        ("HTTPStatus", "http_status"),
        ("a.b", "a_b"),
        ("1st", "_1st"),
        ("_row_id", "_row_id"),
        ("  Spaced  ", "spaced"),
    ],
)
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


def test_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`Order Id` int, `order_id` int")
    with pytest.raises(NameCollisionError, match="order_id"):
        normalize_names(df)


def test_flatten_nested_objects(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 2, "cD": "x"}, "n": 5}')], "id int, payload string")
    flat = flatten(parse_json_column(df, "payload"))
    assert sorted(flat.columns) == ["id", "payload__a__b", "payload__a__c_d", "payload__n"]
    r = flat.first()
    assert (r.payload__a__b, r.payload__a__c_d, r.payload__n) == (2, "x", 5)


def test_child_table_rows_keys_and_empty_lists(spark):
    df = spark.createDataFrame(
        [(1, ["x", "y"]), (2, []), (3, None)], "id long, tags array<string>"
    )
    child = child_table(df, ["id"], "tags").orderBy("_idx").collect()
    assert [(r.id, r._idx, r.value) for r in child] == [(1, 0, "x"), (1, 1, "y")]
    assert child[0]._row_key != child[1]._row_key and len(child[0]._row_key) == 64


def test_child_table_of_objects(spark):
    df = spark.createDataFrame([(1, [(10, "a")])], "id long, items array<struct<qty:int, sku:string>>")
    row = child_table(df, ["id"], "items").first()
    assert (row.qty, row.sku, row._idx) == (10, "a", 0)


def test_split_tables_recurses_into_nested_lists(spark):
    from tidepool.plans.ingest import split_tables

    df = spark.createDataFrame(
        [(1, [(("x", "y"),)])], "id long, items array<struct<tags: array<string>>>"
    )
    parts = {p.name: p for p in split_tables("t", df, ("id",))}
    assert sorted(parts) == ["t", "t__items", "t__items__tags"]
    assert parts["t__items__tags"].primary_key == ("_root_key",)
    tags = parts["t__items__tags"].df.orderBy("_idx").collect()
    assert [r.value for r in tags] == ["x", "y"]
    item_key = parts["t__items"].df.first()._row_key
    assert {r._parent_key for r in tags} == {item_key}
