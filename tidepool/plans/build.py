"""The project build in dependency order: raw sources (tested) -> staging views ->
mart (tested).  A failing test stops the build before anything that depends on the
tested model is built -- the equivalent of running models and tests together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidepool.operators import quality
from tidepool.operators.load import Warehouse
from tidepool.plans import models

RESULT_SCHEMA = StructType(
    [
        StructField("test", StringType()),
        StructField("table_name", StringType()),
        StructField("column_name", StringType()),
        StructField("failures", LongType()),
        StructField("passed", BooleanType()),
    ]
)


def project_steps(raw: dict[str, DataFrame]) -> list[quality.BuildStep]:
    return [
        *[
            quality.BuildStep(name, lambda _, n=name: raw[n], quality.SOURCE_TESTS[name])
            for name in ("customers", "events", "orders")
        ],
        quality.BuildStep("stg_customers", lambda m: models.stg_customers(m["customers"])),
        quality.BuildStep("stg_events", lambda m: models.stg_events(m["events"])),
        quality.BuildStep("stg_orders", lambda m: models.stg_orders(m["orders"])),
        quality.BuildStep(
            "customer_activity",
            lambda m: models.customer_activity(m["stg_customers"], m["stg_events"], m["stg_orders"]),
            quality.MART_TESTS,
            stored=True,
        ),
    ]


def build_project(
    raw: dict[str, DataFrame],
    fail_fast: bool = True,
    warehouse: Warehouse | None = None,
    mart_dataset: str = "analytics",
) -> quality.BuildReport:
    """Run the project; with a warehouse the staging views are created and the mart is written,
    read back and tested as written."""

    def store(name: str, df: DataFrame) -> DataFrame:
        warehouse.load(df, mart_dataset, name, "replace")
        return warehouse.read(mart_dataset, name)

    def view(name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)

    stored = warehouse is not None
    return quality.run_build(
        project_steps(raw), fail_fast, store if stored else None, view if stored else None
    )


def results_frame(spark: SparkSession, report: quality.BuildReport) -> DataFrame:
    """The (small, one row per test) results as a DataFrame."""
    return spark.createDataFrame(
        [{k: r[k] for k in RESULT_SCHEMA.fieldNames()} for r in report.results], RESULT_SCHEMA
    )
