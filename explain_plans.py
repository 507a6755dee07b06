"""Write the formatted physical plans of the main read queries to docs/plans.md.

    python explain_plans.py [data_dir]
"""

from __future__ import annotations

import contextlib
import io
import sys

from tidepool.plans.queries import CORE_QUERIES
from tidepool.session import build_session

KEYS = [
    "customer_activity",
    "card_lifetime_value_filtered",
    "card_customer_detail",
    "dq_unique",
    "dq_not_null",
]


def main(argv):
    data_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "", f"Generated by `explain_plans.py` on `{data_dir}` (before execution;"
           " AQE may still switch joins to broadcast or coalesce partitions at runtime).", ""]
    for key in KEYS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            CORE_QUERIES[key](spark, data_dir).explain("formatted")
        out += [f"## {key}", "", "```", buf.getvalue().strip(), "```", ""]
    # the two write jobs of a merge (scenario load_merge: second batch into the table)
    from tidepool.operators.load import Warehouse
    from tidepool.plans import scenarios
    from tidepool.session import scratch_dir

    orders = scenarios._orders(spark, data_dir)
    first, later = scenarios._merge_batches(orders)
    wh = Warehouse(spark, scratch_dir(spark, "warehouse"))
    wh.load(first, "raw", "orders", "merge", primary_key=["order_id"], order_by=["seq"])
    wh.capture_plans = True
    wh.load(later, "raw", "orders", "merge", order_by=["seq"])
    for label, plan in wh.plans:
        out += [f"## merge: {label}", "", "```", plan.strip(), "```", ""]
    with open("docs/plans.md", "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
