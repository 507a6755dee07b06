from __future__ import annotations

import datetime as dt

import pytest

from tidepool.functions.datetime import parse_datetime_best_effort

CASES = [
    ("2026-08-01T10:00:00Z", dt.datetime(2026, 8, 1, 10)),
    ("2026-08-01T12:00:00+02:00", dt.datetime(2026, 8, 1, 10)),
    ("2026-08-01 10:00:00.789", dt.datetime(2026, 8, 1, 10)),
    ("2026-08-01", dt.datetime(2026, 8, 1)),
    ("1754042400", dt.datetime(2025, 8, 1, 10)),
    ("01/08/2026 10:00", dt.datetime(2026, 8, 1, 10)),
    ("01/08/2026 10:00:05", dt.datetime(2026, 8, 1, 10, 0, 5)),
    ("01/08/2026", dt.datetime(2026, 8, 1)),
    ("2026-03-08 02:30:00", dt.datetime(2026, 3, 8, 2, 30)),  # in New York's DST gap
    ("08/03/2026 02:30", dt.datetime(2026, 3, 8, 2, 30)),
    ("31/02/2026", None),  # not a date -> NULL in non-strict mode
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_accepted_forms_independent_of_session_zone(spark, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(s,) for s, _ in CASES], "s string")
        got = [r.p for r in df.select(parse_datetime_best_effort("s", strict=False).alias("p")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert got == [e for _, e in CASES]


def test_unparseable_raises_or_nulls(spark):
    df = spark.createDataFrame([("not a date",)], "s string")
    with pytest.raises(Exception, match="Cannot parse datetime"):
        df.select(parse_datetime_best_effort("s")).collect()
    assert df.select(parse_datetime_best_effort("s", strict=False).alias("p")).first().p is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_format_ntz_is_zone_free(spark, zone):
    from pyspark.sql import functions as F

    from tidepool.functions.datetime import format_ntz

    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(dt.datetime(2026, 3, 8, 2, 30, 5),)], "t timestamp_ntz")
        row = df.select(
            format_ntz("t").alias("iso"),
            format_ntz("t", date_sep="/", day_first=True, seconds=False).alias("dmy"),
            F.col("t"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert (row.iso, row.dmy) == ("2026-03-08 02:30:05", "08/03/2026 02:30")
