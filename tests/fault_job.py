"""Run by test_fault_tolerance.py in its own process (task retries need a master
like local[N,F]).  A test-only UDF fails the first attempt of one task."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType  # noqa: E402

from tidepool.operators.load import Warehouse  # noqa: E402
from tidepool.session import build_session  # noqa: E402


MARKERS = tempfile.mkdtemp(prefix="fault-markers-")


@F.udf(LongType())
def flaky(x):
    ctx = TaskContext.get()
    if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        # local mode: the driver sees this folder too
        open(os.path.join(MARKERS, f"stage-{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return x


def main() -> None:
    root = tempfile.mkdtemp(prefix="fault-")
    spark = build_session("local[4,4]", shuffle_partitions=4, conf={"spark.checkpoint.dir": root})
    spark.sparkContext.setLogLevel("OFF")
    wh = Warehouse(spark, f"{root}/wh", buckets=4)

    base = spark.range(0, 1000, numPartitions=4).select(
        F.col("id"), (F.col("id") * 2).alias("v"), F.lit(1).alias("seq")
    )
    # append: the failing task is in the writing stage itself
    res = wh.load(base.withColumn("v", flaky("v")), "ds", "plain", "append")
    assert res.rows_loaded == 1000, res
    assert wh.read("ds", "plain").count() == 1000

    # merge: the failing task is in the batch's map stage
    wh.load(base, "ds", "keyed", "merge", primary_key=["id"], order_by=["seq"])
    update = spark.range(500, 1500, numPartitions=4).select(
        F.col("id"), flaky(F.col("id") * 3).alias("v"), F.lit(2).alias("seq")
    )
    res = wh.load(update, "ds", "keyed", "merge", order_by=["seq"])
    assert res.rows_loaded == 1000, res
    rows = wh.read("ds", "keyed")
    assert rows.count() == 1500
    assert rows.where("id >= 500 AND v != id * 3").count() == 0
    assert rows.where("id < 500 AND v != id * 2").count() == 0
    audit = [r.rows_loaded for r in wh.audit().orderBy("load_seq").collect()]
    assert audit == [1000, 1000, 1000], audit
    injected = sorted(os.listdir(MARKERS))
    assert len(injected) == 2, injected  # one failed attempt per flaky load
    print("FAULT-TOLERANCE-OK", injected)


if __name__ == "__main__":
    main()
