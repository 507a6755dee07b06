"""Normalization of loaded records: snake_case names, flattened nested objects and
lists split into child tables.

All three are projections (plus one ``posexplode`` for child tables): no grouping,
so they add no shuffle and a hot key costs nothing extra.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# Separator between a parent field and a nested field, and the names of
# the columns added to child tables.
NESTING_SEPARATOR = "__"
CHILD_INDEX = "_idx"
CHILD_VALUE = "value"
ROW_KEY = "_row_key"
PARENT_KEY = "_parent_key"
ROOT_KEY = "_root_key"


class NameCollisionError(ValueError):
    """Two source columns normalize to the same name."""


def snake_case(name: str) -> str:
    """``CustomerName`` / ``customer name`` / ``Customer-Name`` -> ``customer_name``."""
    s = name.strip()
    lead = "_" if s.startswith("_") else ""  # system columns keep their marker
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = s.lower()
    s = re.sub(r"[^a-z0-9]+", "_", s).strip("_")
    if not s or s[0].isdigit():
        lead = "_"
    return lead + s


def _check_unique(pairs: list[tuple[str, str]]) -> None:
    seen: dict[str, str] = {}
    for original, new in pairs:
        if new in seen:
            raise NameCollisionError(
                f"Columns {seen[new]!r} and {original!r} both normalize to {new!r}"
            )
        seen[new] = original


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename top-level columns to snake_case; colliding names raise."""
    pairs = [(c, snake_case(c)) for c in df.columns]
    _check_unique(pairs)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in pairs])


def _flatten_fields(
    schema: StructType, prefix: list[str], path: list[str]
) -> list[tuple[str, str, Column]]:
    """(source path, flattened name, column) for every leaf field."""
    out = []
    for f in schema.fields:
        ref = path + [f.name]
        names = prefix + [snake_case(f.name)]
        if isinstance(f.dataType, StructType):
            out += _flatten_fields(f.dataType, names, ref)
        else:
            expr = F.col(".".join(f"`{p}`" for p in ref))
            out.append((".".join(ref), NESTING_SEPARATOR.join(names), expr))
    return out


def _select_flat(df: DataFrame, leaves: list[tuple[str, str, Column]], keep: list[Column]) -> DataFrame:
    _check_unique([(src, name) for src, name, _ in leaves])
    return df.select(*keep, *[expr.alias(name) for _, name, expr in leaves])


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects become columns ``parent__child`` (recursively); lists stay."""
    return _select_flat(df, _flatten_fields(df.schema, [], []), [])


def parse_json_column(df: DataFrame, column: str, schema: StructType | str | None = None) -> DataFrame:
    """Replace a JSON-text column by a struct, ready for :func:`flatten`.

    Without a schema, one aggregation over the column infers it
    (``schema_of_variant_agg``); values of conflicting types become ``variant``.
    """
    if schema is None:
        ddl = df.select(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("s")).first().s
        schema = re.sub(r"\bOBJECT<", "STRUCT<", ddl)
    return df.withColumn(column, F.from_json(F.col(column), schema))


def row_key(*cols: Column | str) -> Column:
    """Deterministic key from values (never from partition ids)."""
    return F.sha2(F.concat(*[_framed(c) for c in cols]), 256)


def _framed(c: Column | str) -> Column:
    """Length-prefixed, so that no two lists of values read the same."""
    value = (F.col(c) if isinstance(c, str) else c).cast("string")
    framed = F.concat(F.length(value).cast("string"), F.lit(":"), value, F.lit(";"))
    return F.coalesce(framed, F.lit("N;"))


def key_columns(keys: dict) -> tuple[str, ...]:
    """The key of a table as :func:`with_keys` gives it."""
    if not keys["child"]:
        return tuple(keys["root"])
    return (ROOT_KEY,) if keys["at"] else (PARENT_KEY,)


def with_keys(df: DataFrame, keys: dict) -> DataFrame:
    """Key columns of a table that is stored without them.

    ``keys``: the columns with the outermost parent's primary key (``root``), and in a child table those
    with the positions of the rows between (``at``, outermost first).  ``row_key`` of them is what
    :func:`child_table` would have stored, level by level; the columns named in ``keys`` are left out.
    """
    root = row_key(*[F.col(f"`{c}`") for c in keys["root"]])
    if not keys["child"]:
        return df.withColumn(ROW_KEY, root)

    def below(key: Column, at: str) -> Column:  # row_key(key, at), of a key known to have 64 characters
        return F.sha2(F.concat(F.lit("64:"), key, F.lit(";"), _framed(at)), 256)

    parent = root
    for at in keys["at"]:
        parent = below(parent, at)
    stored = {*keys["root"], *keys["at"]}
    return df.select(
        parent.alias(PARENT_KEY),
        *([root.alias(ROOT_KEY)] if keys["at"] else []),
        *[F.col(f"`{c}`") for c in df.columns if c not in stored],
        below(parent, CHILD_INDEX).alias(ROW_KEY),
    )


def child_table(
    df: DataFrame, parent_key: list[str], list_column: str, carried: list[str] | None = None
) -> DataFrame:
    """One row per list element: parent key, ``carried`` columns of the parent, zero-based
    ``_idx``, the element (flattened when it is an object) and a deterministic ``_row_key``.

    Parents whose list is NULL or empty contribute no rows.
    """
    elem_type = df.schema[list_column].dataType
    if not isinstance(elem_type, ArrayType):
        raise ValueError(f"{list_column} is not a list")
    kept = [F.col(f"`{k}`") for k in [*parent_key, *(carried or [])]]
    exploded = df.select(
        *kept,
        F.posexplode(F.col(f"`{list_column}`")).alias(CHILD_INDEX, "_elem"),
    )
    if isinstance(elem_type.elementType, StructType):
        elem_cols = [e.alias(n) for _, n, e in _flatten_fields(elem_type.elementType, [], ["_elem"])]
    else:
        elem_cols = [F.col("_elem").alias(CHILD_VALUE)]
    return exploded.select(
        *kept,
        F.col(CHILD_INDEX).cast("bigint").alias(CHILD_INDEX),
        *elem_cols,
        row_key(*parent_key, CHILD_INDEX).alias(ROW_KEY),
    )


def split_lists(df: DataFrame, parent_key: list[str]) -> dict[str, DataFrame]:
    """Parent table without list columns, plus one child table per list column
    (named ``<list column>``)."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    out = {"": df.drop(*lists)}
    for name in lists:
        out[name] = child_table(df, parent_key, name)
    return out
