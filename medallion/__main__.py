"""Command line: run layers, the whole flow, the tests, or the streaming form.

    python -m medallion run      --landing RAW --warehouse WH [--pages JSON] [--full-refresh] [--no-archive] [--no-test]
    python -m medallion layer    --landing RAW --warehouse WH bronze|silver|gold [--full-refresh]
    python -m medallion test     --landing RAW --warehouse WH
    python -m medallion archive  --landing RAW --warehouse WH
    python -m medallion compact  --landing RAW --warehouse WH
    python -m medallion stream   --landing RAW --warehouse WH [--no-archive]

Cluster resources come from ``spark-submit``; the session only pins the
semantic settings (UTC, AQE).
"""

from __future__ import annotations

import argparse
import json

from medallion.plans.models import DEFAULT_COUNTRY_IDS
from medallion.plans.runner import PipelineConfig, Runner
from medallion.session import build_session


def _config(args) -> PipelineConfig:
    return PipelineConfig(
        landing_root=args.landing,
        warehouse_root=args.warehouse,
        country_ids=tuple(int(x) for x in args.countries.split(",")) if args.countries else DEFAULT_COUNTRY_IDS,
        bronze_watermark=args.bronze_watermark,
        measurement_mode=args.measurement_mode,
        aggregate_mode=args.aggregate_mode,
        locality_mode=args.locality_mode,
        side_by_side=args.side_by_side,
        catalog=args.catalog,
        pages_root=args.pages,
    )


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="medallion")
    p.add_argument("command", choices=["run", "layer", "test", "archive", "compact", "stream"])
    p.add_argument("layer", nargs="?", choices=["bronze", "silver", "gold"])
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--master", default=None)
    p.add_argument("--profile", default=None, choices=["cluster"],
                   help="sizing for large inputs (shuffle/scan partition sizes, skew thresholds)")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--no-archive", action="store_true")
    p.add_argument("--no-test", action="store_true")
    p.add_argument("--countries", default="")
    p.add_argument("--bronze-watermark", action="store_true")
    p.add_argument("--measurement-mode", default="upsert", choices=["upsert", "append"])
    p.add_argument("--aggregate-mode", default="merge", choices=["merge", "recompute", "append"])
    p.add_argument("--locality-mode", default="groups", choices=["groups", "rebuild", "incremental"])
    p.add_argument("--side-by-side", type=int, default=4, help="models that run at the same time")
    p.add_argument("--catalog", default=None, help="publish tables as views, in databases <prefix>bronze, ...")
    p.add_argument("--pages", default=None, help="raw JSON pages to land first: <pages>/<entity>/*.json")
    args = p.parse_args(argv)

    spark = build_session(args.master, profile=args.profile)
    cfg = _config(args)
    runner = Runner(spark, cfg)
    result = None
    if args.command == "run":
        result = runner.run_pipeline(full_refresh=args.full_refresh, archive=not args.no_archive,
                                     test=not args.no_test)
    elif args.command == "layer":
        if not args.layer:
            p.error("layer needs bronze, silver or gold")
        print(json.dumps(runner.run_layer(args.layer, full_refresh=args.full_refresh)))
    elif args.command == "test":
        result = runner.test()
    elif args.command == "archive":
        print(json.dumps(runner.archive()))
    elif args.command == "compact":
        print(json.dumps(runner.compact()))
    else:
        from medallion.streaming.incremental import run_available_now

        result = run_available_now(spark, cfg, archive=not args.no_archive, test=not args.no_test)
    if result is not None:
        for row in result.collect():  # one row per test: (test, failures)
            print(json.dumps(row.asDict()))


if __name__ == "__main__":
    main()
