"""API resources landed as JSON page files.

Fetching over HTTP is outside Spark; what Spark does is turn the landed response
pages into tables.  Each resource is a folder of page documents; the records sit at
``data_selector`` (a dotted path, default: the document root).  Every record gets the
page number and its position within the page, so the original order is recoverable
without relying on file listing order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources.documents import read_json_documents
from tidepool.sources.files import join_path

# The file pattern of a page (any visible file below the resource
# folder; Spark skips names starting with "_" or "."), the page-number field inside a
# page and the columns added to each record.
PAGE_GLOB = "*"
PAGE_FIELD = "page"
PAGE_COLUMN = "_page"
POSITION_COLUMN = "_page_pos"


def read_resource(
    spark: SparkSession,
    landing_url: str,
    resource_path: str,
    data_selector: str | None = None,
    schema=None,
    page_glob: str = PAGE_GLOB,
    staging: str | None = None,
) -> DataFrame:
    """All pages of one resource as rows, with ``_page`` and ``_page_pos``."""
    pattern = join_path(join_path(landing_url, resource_path), f"**/{page_glob}")
    page_from_file = F.regexp_extract(F.col("_file"), r"(\d+)[^/\d]*$", 1).try_cast("bigint")
    page = F.coalesce(F.variant_get("doc", f"$.{PAGE_FIELD}", "bigint"), page_from_file)
    return read_json_documents(
        spark,
        pattern,
        data_selector,
        schema=schema,
        doc_columns={PAGE_COLUMN: page},
        position_column=POSITION_COLUMN,
        staging=staging,
    )
