"""Scalar casts used by the staging models and report cards.

All of them are plain Catalyst casts: they stay inside whole-stage codegen.  With
ANSI mode on (Spark's default) an unparseable string raises, as the warehouse's
typed conversions do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int64(c: ColumnOrName) -> Column:
    return _col(c).cast("bigint")


def to_decimal(c: ColumnOrName, scale: int = 2, precision: int = 18) -> Column:
    """Fixed-point money.  Spark rounds half-up on the decimal digits of the value."""
    return _col(c).cast(DecimalType(precision, scale))


def to_float64(c: ColumnOrName) -> Column:
    return _col(c).cast("double")


def to_string(c: ColumnOrName) -> Column:
    return _col(c).cast("string")


def zero_if_null(c: ColumnOrName, zero: Column | int = 0) -> Column:
    """``coalesce(c, 0)`` -- the value an empty or unmatched aggregate reports."""
    return F.coalesce(_col(c), zero if isinstance(zero, Column) else F.lit(zero))
