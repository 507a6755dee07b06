"""File sources: CSV (plain or gzip), JSON Lines and Parquet, with ``**`` globs.

Spark's own path globbing expands ``*``, ``?``, ``[...]`` and ``{a,b}`` within one
directory level only, so ``events/**/*.jsonl`` would match exactly one level.  A
pattern containing ``**`` is split into a literal base directory read with
``recursiveFileLookup`` plus a ``pathGlobFilter`` for the file-name part; whatever the
two cannot express is checked against ``_metadata.file_path``.

Timestamp policy of the raw layer: zone-less timestamps are ``timestamp_ntz``;
zoned ones are converted to UTC wall clock ``timestamp_ntz``.  Downstream code never
depends on the session time zone.
"""

from __future__ import annotations

import contextlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from tidepool.functions.datetime import instant_to_utc_ntz

GLOB_CHARS = set("*?[{")


@dataclass(frozen=True)
class FileSelection:
    """Where Spark should look, and what it must keep."""

    path: str
    options: dict[str, str]
    path_regex: str | None = None  # residual check on _metadata.file_path


def join_path(base_url: str, file_glob: str) -> str:
    return f"{base_url.rstrip('/')}/{file_glob.lstrip('/')}"


def glob_to_regex(glob: str) -> str:
    """Translate a path glob (``**``, ``*``, ``?``, ``[..]``, ``{a,b}``) to a regex."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        if glob.startswith("**/", i):
            out.append("(?:.*/)?")
            i += 3
        elif glob.startswith("**", i):
            out.append(".*")
            i += 2
        elif ch == "*":
            out.append("[^/]*")
            i += 1
        elif ch == "?":
            out.append("[^/]")
            i += 1
        elif ch == "[":
            end = glob.find("]", i + 1)
            if end < 0:
                out.append(re.escape(ch))
                i += 1
            else:
                body = glob[i + 1 : end]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append(f"[{body}]")
                i = end + 1
        elif ch == "{":
            end = glob.find("}", i + 1)
            if end < 0:
                out.append(re.escape(ch))
                i += 1
            else:
                alts = glob[i + 1 : end].split(",")
                out.append("(?:" + "|".join(re.escape(a) for a in alts) + ")")
                i = end + 1
        else:
            out.append(re.escape(ch))
            i += 1
    return "".join(out)


def select_files(pattern: str) -> FileSelection:
    """Plan how to read every file matching ``pattern`` (which may contain ``**``)."""
    if "**" not in pattern:
        return FileSelection(pattern, {})
    parts = pattern.split("/")
    first_glob = next(i for i, p in enumerate(parts) if any(c in GLOB_CHARS for c in p))
    base = "/".join(parts[:first_glob]) or "/"
    rest = parts[first_glob:]
    options = {"recursiveFileLookup": "true"}
    name = rest[-1]
    if "**" not in name:
        options["pathGlobFilter"] = name
    middle = rest[:-1]
    residual = None
    if any(p != "**" for p in middle) or "**" in name:
        base_no_scheme = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", base).rstrip("/")
        base_no_scheme = re.sub(r"^/+", "/", base_no_scheme)
        residual = re.escape(base_no_scheme) + "/" + glob_to_regex("/".join(rest)) + "$"
    return FileSelection(base, options, residual)


@contextlib.contextmanager
def _ntz_inference(spark: SparkSession):
    """Let schema inference type zone-less strings as ``timestamp_ntz``."""
    key = "spark.sql.timestampType"
    previous = spark.conf.get(key, None)
    spark.conf.set(key, "TIMESTAMP_NTZ")
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def normalize_timestamps(df: DataFrame) -> DataFrame:
    """Zoned ``timestamp`` columns -> UTC wall clock ``timestamp_ntz`` (top level)."""
    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            instant_to_utc_ntz(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def decoded_file_path() -> Column:
    """The path of a row's file; ``_metadata.file_path`` is percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _matching_files(spark: SparkSession, sel: FileSelection, options: dict[str, str]) -> list[str]:
    """Paths that a residual pattern selects (a listing: no content is read).

    The names are the driver's anyway: every file scan is planned from them.
    """
    listing = spark.read.format("binaryFile").options(**options).options(**sel.options).load(sel.path)
    found = [r.path for r in listing.select("path").where(F.col("path").rlike(sel.path_regex)).collect()]
    if not found:
        raise FileNotFoundError(f"No file below {sel.path} matches the pattern")
    return sorted(found)


def read_files(
    spark: SparkSession,
    pattern: str,
    fmt: str,
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read every file matching ``pattern`` as one DataFrame (an implicit UNION ALL).

    ``fmt``: ``csv`` (gzip recognised by suffix), ``jsonl`` or ``parquet``.  With
    ``schema`` no inference pass is made -- recommended for large inputs.
    """
    sel = select_files(pattern)
    given = options or {}
    if sel.path_regex is not None:  # the excluded files must not take part in inference
        files, reader = _matching_files(spark, sel, given), spark.read.options(**given)
    else:
        files, reader = sel.path, spark.read.options(**sel.options).options(**given)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt != "parquet" and "mode" not in given:
        reader = reader.option("mode", "FAILFAST")  # a malformed record stops the read
    if fmt in ("csv", "csv.gz"):
        # every file's header is checked against the schema: a file with reordered
        # or renamed columns fails instead of being mapped by position
        reader = reader.option("header", "true").option("enforceSchema", "false")
        # a quote inside a quoted field is doubled; ``multiLine`` (line breaks inside
        # quotes) is a source option, since it makes files unsplittable
        reader = reader.option("quote", '"').option("escape", given.get("escape", '"'))
        if schema is None:
            reader = reader.option("inferSchema", "true")
        with _ntz_inference(spark):
            df = reader.csv(files)
    elif fmt in ("jsonl", "ndjson"):
        if schema is None:
            reader = reader.option("inferTimestamp", "true")
        with _ntz_inference(spark):
            df = reader.json(files)
    elif fmt == "parquet":
        if schema is None and "mergeSchema" not in (options or {}):
            # files of one source may have gained columns over time: union the
            # footers (read in parallel) instead of trusting one file's schema
            reader = reader.option("mergeSchema", "true")
        df = reader.parquet(*files) if isinstance(files, list) else reader.parquet(files)
    else:
        raise ValueError(f"Unsupported file format: {fmt}")
    return normalize_timestamps(df)


# The format of a file by its name's last suffixes.
SUFFIX_FORMATS = {
    "csv": "csv",
    "json": "json",
    "jsonl": "json",
    "ndjson": "json",
    "parquet": "parquet",
}
COMPRESSED = ("gz", "bz2", "zst")


def infer_format(path: str) -> str:
    """The reader for a path, from the suffix of its last part (a compression suffix aside).

    A directory or a glob without a known suffix is taken as Parquet, Spark's own layout;
    a plain name without one is an error.  A ``?key=value`` query at the end is ignored.
    """
    name = re.sub(r"\?[\w.-]+=.*$", "", path)  # a query, not a one-character wildcard
    last = name.rstrip("/").rsplit("/", 1)[-1].lower()
    suffixes = last.split(".")[1:]
    if suffixes and suffixes[-1] in COMPRESSED:
        suffixes.pop()
    known = SUFFIX_FORMATS.get(suffixes[-1]) if suffixes else None
    if known:
        return known
    if any(c in last for c in GLOB_CHARS) or path.endswith("/"):
        return "parquet"
    raise ValueError(f"No reader for {path}: its name has none of the suffixes {', '.join(SUFFIX_FORMATS)}")
