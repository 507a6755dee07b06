"""Command line: validate a spec, ingest it, build and test the mart, query a file.

    python -m tidepool validate config/sources.yml
    python -m tidepool ingest   config/sources.yml --warehouse /shared/warehouse
    python -m tidepool build    --warehouse /shared/warehouse --dataset raw_local_demo
    python -m tidepool query    data/orders.parquet --sql "select count(*) from source"
"""

from __future__ import annotations

import argparse
import sys


def _validate(ns) -> int:
    from tidepool.sources.registry import supported_types
    from tidepool.spec import load_source_specs

    specs = load_source_specs(ns.spec)
    unknown = [s.name for s in specs if s.enabled and s.type not in supported_types()]
    if unknown:
        print(f"unsupported connector type in: {', '.join(unknown)}", file=sys.stderr)
        return 1
    enabled = [s for s in specs if s.enabled]
    print(f"{len(specs)} sources, {len(enabled)} enabled: {', '.join(s.name for s in enabled)}")
    return 0


def _ingest(ns) -> int:
    from tidepool.operators.load import Warehouse
    from tidepool.plans.ingest import ingest_all
    from tidepool.session import build_session
    from tidepool.spec import load_source_specs

    spark = build_session()
    wh = Warehouse(spark, ns.warehouse, catalog=True)
    for report in ingest_all(spark, load_source_specs(ns.spec), wh):
        for load in report.loads:
            print(f"{report.source} {report.dataset}.{load.table} {load.disposition} rows={load.rows_loaded}")
    return 0


def _build(ns) -> int:
    from tidepool.operators.load import Warehouse
    from tidepool.operators.quality import DataTestFailure
    from tidepool.plans.build import build_project
    from tidepool.session import build_session

    spark = build_session()
    wh = Warehouse(spark, ns.warehouse, catalog=True)
    raw = {t: wh.read(ns.dataset, t) for t in ("customers", "events", "orders")}
    try:
        report = build_project(raw, warehouse=wh, mart_dataset=ns.mart_dataset)
    except DataTestFailure as failure:
        print(failure, file=sys.stderr)
        return 1
    for r in report.results:
        print(f"{r['test']} {r['table_name']}.{r['column_name']} failures={r['failures']}")
    print(f"{ns.mart_dataset}.customer_activity materialized")
    return 0


def _query(ns) -> int:
    from tidepool.plans.adhoc import main as adhoc_main

    adhoc_main([ns.path, "--sql", ns.sql])
    return 0


def main(argv: list[str] | None = None) -> int:
    from tidepool.plans.adhoc import DEFAULT_SQL

    parser = argparse.ArgumentParser(prog="tidepool")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("validate")
    p.add_argument("spec")
    p.set_defaults(fn=_validate)
    p = sub.add_parser("ingest")
    p.add_argument("spec")
    p.add_argument("--warehouse", required=True)
    p.set_defaults(fn=_ingest)
    p = sub.add_parser("build")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--dataset", default="raw_local_demo")
    p.add_argument("--mart-dataset", default="analytics")
    p.set_defaults(fn=_build)
    p = sub.add_parser("query")
    p.add_argument("path")
    p.add_argument("--sql", default=DEFAULT_SQL)
    p.set_defaults(fn=_query)
    ns = parser.parse_args(argv)
    return ns.fn(ns)


if __name__ == "__main__":
    sys.exit(main())
