"""Command line: ``python -m strata <command>`` (or the same module via spark-submit).

    ingest   raw CSV folder -> bronze batch folders (year-window split + pass-through, snapshot)
    run      bronze -> silver -> gold, prints the status and null-policy tables
    publish  copy a layer's tables to another filesystem URI
"""

from __future__ import annotations

import argparse
import sys

from strata.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("raw"), a.add_argument("bronze")
    a.add_argument("--start", type=int, default=2013), a.add_argument("--end", type=int, default=2014)
    a.add_argument("--label", default="actual"), a.add_argument("--snapshot-label", default="upcoming")
    r = sub.add_parser("run")
    r.add_argument("bronze"), r.add_argument("silver"), r.add_argument("gold")
    r.add_argument("--workers", type=int, default=4)
    r.add_argument("--database", help="publish tables as catalog entries <database>_silver.* and <database>_gold.*")
    r.add_argument("--status", help="folder that keeps the status; a run after a failed one goes on from it")
    p = sub.add_parser("publish")
    p.add_argument("src"), p.add_argument("dst")
    p.add_argument("--format", default="parquet"), p.add_argument("--domains", nargs="*")
    p.add_argument("--recursive", action="store_true", help="publish the tables at any depth")
    args = ap.parse_args(argv)

    spark = get_session()
    failed = 0

    def show(df) -> None:
        # a status row per table: print all of them in full
        for row in df.collect():
            print(" | ".join("" if v is None else str(v) for v in row))

    if args.cmd == "ingest":
        from strata.plans.ingest_jobs import snapshot, split_batch
        st = split_batch(spark, args.raw, args.bronze, args.start, args.end, label=args.label)
        st = st.unionByName(snapshot(spark, args.raw, args.bronze, label=args.snapshot_label))
        show(st)
        failed = st.where("status IN ('failed', 'missing')").count()
    elif args.cmd == "run":
        from strata.operators.quality import run_summary
        from strata.plans.runner import run_all
        status, policy = run_all(spark, args.bronze, args.silver, args.gold, workers=args.workers, database=args.database, status_path=args.status)
        show(status)
        show(policy.where("status <> 'ok'"))
        show(run_summary(status))
        failed = status.where("status IN ('failed', 'blocked')").count()
    elif args.cmd == "publish":
        from strata.sources.publish import publish_layer
        st = publish_layer(spark, args.src, args.dst, fmt=args.format, domains=args.domains, recursive=args.recursive)
        show(st)
        failed = st.where("status = 'failed'").count()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
