"""JSON document files: each file holds one object, or an array of objects, possibly
below a dotted ``records_path``.

A document is not splittable, so each file is read whole (``wholetext``) as one row
and parsed to ``VARIANT`` inside the JVM, once.  Files are spread over tasks; nothing is
funnelled through the driver.  One job stages the records as Parquet ``VARIANT`` in the shared
scratch folder and observes on the way what the records are like and whether they are valid:

* a ``records_path`` component missing in *any* file     -> error
* a root (after the path) that is neither object nor array -> error
* an array element that is not an object                  -> error

Validation happens before anything is returned, so a failing input loads nothing.
Typed columns are projected from the staged records: by an explicit schema, or by the merged
schema of all records, in which strings that all read as timestamps are timestamps, fractions are
doubles, and values of conflicting types are text -- what the JSON Lines reader infers.
Ingestion deletes the staged records when they are loaded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from tidepool.session import scratch_dir
from tidepool.sources.files import decoded_file_path, normalize_timestamps, select_files


class DocumentError(ValueError):
    """A JSON document does not resolve to objects."""


# Messages of the three document errors.
MISSING_PATH = "some document lacks the records_path {path}"
NOT_OBJECTS = "JSON arrays must contain objects"
BAD_ROOT = "some document is neither an object nor an array"


def _variant_path(records_path: str | None) -> str:
    if not records_path:
        return "$"
    return "$" + "".join(f"['{part}']" for part in records_path.split("."))


def document_records(
    spark: SparkSession,
    pattern: str,
    records_path: str | None = None,
    options: dict[str, str] | None = None,
    doc_columns: dict[str, Column] | None = None,
) -> DataFrame:
    """Lazy records with per-row validity flags (not yet validated).

    ``doc_columns`` are expressions over the parsed document (``doc``) and its file
    (``_file``), evaluated once per document before the records are exploded; the
    document itself is never carried into the per-record rows (that would copy a
    whole document once per record).
    """
    sel = select_files(pattern)
    reader = spark.read.options(**sel.options).options(**(options or {}))
    # the keyword, not an option: text() would reset the option to its own default
    docs = reader.text(sel.path, wholetext=True)
    if sel.path_regex is not None:
        docs = docs.where(decoded_file_path().rlike(sel.path_regex))
    docs = docs.select(
        F.col("_metadata.file_path").alias("_file"),
        F.parse_json("value").alias("doc"),
    )
    per_doc = doc_columns or {}
    selected = (
        F.col("doc")
        if not records_path
        else F.variant_get("doc", _variant_path(records_path), "variant")
    )
    kind = F.schema_of_variant(F.col("sel"))
    elements = (
        F.when(kind.startswith("OBJECT"), F.array(F.col("sel")))
        .when(kind.startswith("ARRAY"), F.col("sel").cast("array<variant>"))
    )
    staged = docs.select(
        "_file", *[c.alias(n) for n, c in per_doc.items()], selected.alias("sel")
    ).select(
        "_file",
        *per_doc.keys(),
        F.col("sel").isNull().alias("_missing_path"),
        (F.col("sel").isNotNull() & elements.isNull()).alias("_bad_root"),
        elements.alias("elements"),
    )
    return staged.select(
        "_file",
        *per_doc.keys(),
        "_missing_path",
        "_bad_root",
        F.posexplode_outer("elements").alias("_pos", "record"),
    ).withColumn(
        # only an object casts to a map (cheaper than rendering each record's schema)
        "_not_object",
        F.col("record").isNotNull()
        & F.try_variant_get("record", "$", "map<string,variant>").isNull(),
    )


def _checks() -> list[Column]:
    return [
        F.count_if("_missing_path").alias("missing_path"),
        F.count_if("_bad_root").alias("bad_root"),
        F.count_if("_not_object").alias("not_object"),
        F.count_if(F.col("_pos").isNotNull()).alias("records"),
    ]


def _raise_on(counts: dict, records_path: str | None) -> None:
    if counts.get("missing_path"):
        raise DocumentError(MISSING_PATH.format(path=records_path))
    if counts.get("bad_root"):
        raise DocumentError(BAD_ROOT)
    if counts.get("not_object"):
        raise DocumentError(NOT_OBJECTS)


# -- the records' schema ------------------------------------------------------------------


def _settled(kind: DataType) -> DataType:
    """The column type of a merged record type: no decimals, no types without values."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, DecimalType):
        return DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def _ddl(kind: DataType) -> str:
    """``kind`` as text, names quoted."""
    if isinstance(kind, StructType):
        quoted = (f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{', '.join(quoted)}>"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, ArrayType) else kind.simpleString()


Test = Callable[[Column], Column]


def _string_leaves(kind: DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Callable[[Test], Test]]]:
    """Every string below ``kind``: its path, and how to test whether any of a value's strings there fails."""
    if isinstance(kind, StringType):
        yield path, lambda test: test
    elif isinstance(kind, StructType):
        for f in kind.fields:
            for at, lift in _string_leaves(f.dataType, (*path, f.name)):
                yield at, lambda test, lift=lift, name=f.name: lambda c: lift(test)(c.getField(name))
    elif isinstance(kind, ArrayType):
        for at, lift in _string_leaves(kind.elementType, (*path, "[]")):
            yield at, lambda test, lift=lift: lambda c: F.exists(c, lift(test))


def _retyped(kind: DataType, types: dict[tuple[str, ...], DataType], path: tuple[str, ...] = ()) -> DataType:
    if isinstance(kind, StructType):
        fields = [StructField(f.name, _retyped(f.dataType, types, (*path, f.name))) for f in kind.fields]
        return StructType(fields)
    if isinstance(kind, ArrayType):
        return ArrayType(_retyped(kind.elementType, types, (*path, "[]")))
    return types.get(path, kind)


def _not_a(kind: DataType) -> Test:
    return lambda c: c.isNotNull() & c.try_cast(kind).isNull()


def _with_timestamps(records: DataFrame, schema: StructType) -> StructType:
    """``schema`` with the strings that all read as timestamps typed so (one pass over them)."""
    leaves = list(_string_leaves(schema))
    if not leaves:
        return schema
    kinds = (TimestampNTZType(), TimestampType())
    aggs = []
    for i, (_, lift) in enumerate(leaves):
        for k, kind in enumerate(kinds):
            fails = lift(_not_a(kind))(F.col("r"))
            aggs.append(F.count_if(F.coalesce(fails, F.lit(False))).alias(f"f{i}_{k}"))
        aggs.append(F.count_if(F.coalesce(lift(lambda c: c.isNotNull())(F.col("r")), F.lit(False))).alias(f"n{i}"))
        # an offset makes a time an instant; without one it is a wall-clock time
        zoned = lift(lambda c: c.rlike(r"(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$") & c.rlike(":"))(F.col("r"))
        aggs.append(F.count_if(F.coalesce(zoned, F.lit(False))).alias(f"z{i}"))
    typed = records.select(F.variant_get("record", "$", _ddl(schema)).alias("r"))
    found = typed.agg(*aggs).first()
    types = {}
    for i, (path, _) in enumerate(leaves):
        if not found[f"n{i}"]:
            continue
        if not found[f"z{i}"] and not found[f"f{i}_0"]:
            types[path] = kinds[0]
        elif not found[f"f{i}_1"]:
            types[path] = kinds[1]
    return _retyped(schema, types)


def read_json_documents(
    spark: SparkSession,
    pattern: str,
    records_path: str | None = None,
    schema: StructType | str | None = None,
    doc_columns: dict[str, Column] | None = None,
    position_column: str | None = None,
    options: dict[str, str] | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Read JSON documents as a typed DataFrame, one row per record.

    ``doc_columns``: per-document values (expressions over ``doc`` and ``_file``,
    e.g. a page number) added to each of its records; ``position_column``: name for
    the record's zero-based position in its document.  ``staging``: a new folder for the staged
    records, which the caller deletes when the rows are used up (else one of the scratch folder).
    """
    flagged = document_records(spark, pattern, records_path, options, doc_columns)
    extra = {name: F.col(name) for name in (doc_columns or {})}
    if position_column:
        extra[position_column] = F.col("_pos").cast("bigint")
    staging = staging or scratch_dir(spark, "documents")
    obs = Observation("document_checks")
    rows = flagged.observe(obs, *_checks(), F.schema_of_variant_agg("record").alias("schema"))
    carried = [c.alias(f"__x{i}") for i, c in enumerate(extra.values())]
    rows = rows.where(F.col("_pos").isNotNull()).select("record", *carried)
    rows.write.parquet(staging)
    found = obs.get
    _raise_on(found, records_path)
    records = spark.read.schema(rows.schema).parquet(staging)
    names = [F.col(f"__x{i}").alias(name) for i, name in enumerate(extra)]
    if schema is not None:
        # from text, not by a variant cast: a value that does not fit stops the read
        typed = F.from_json(F.to_json("record"), schema, {"mode": "FAILFAST"})
        return records.select(typed.alias("r"), *names).select("r.*", *extra)
    if not found.get("records"):
        return spark.createDataFrame([], StructType([]))
    merged = StructType.fromDDL("r " + re.sub(r"\bOBJECT<", "STRUCT<", found["schema"]))["r"].dataType
    kind = _with_timestamps(records, _settled(merged))
    typed = records.select(F.variant_get("record", "$", _ddl(kind)).alias("r"), *names)
    return normalize_timestamps(typed.select("r.*", *extra))
