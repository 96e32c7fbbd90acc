"""Command line: build the mart of an input folder or run catalogue queries.

    python -m vitalmart list
    python -m vitalmart build --sf /root/testdata/sf0.01
    python -m vitalmart query q_ws_region_rank --sf /root/testdata/sf0.01 [--show 20]
    python -m vitalmart query q_ws_trend --sf ... --out /shared/results/trend   (parquet)
    python -m vitalmart load --landing <root with WDI/ and WHO/> --out <folder>
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="vitalmart")
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--master", default=None, help="Spark master (default: as configured)")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    b = sub.add_parser("build", parents=[common],
                       help="build (or reuse) the mart of an input folder")
    b.add_argument("--sf", required=True, help="folder with the input parquet tables")
    ld = sub.add_parser("load", parents=[common],
                        help="staging and star from landing files (full refresh)")
    ld.add_argument("--landing", required=True, help="folder with WDI/ and WHO/ files")
    ld.add_argument("--out", required=True, help="folder for the staging and star tables")
    q = sub.add_parser("query", parents=[common], help="run one registered query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--show", type=int, default=20, help="rows to print (ignored with --out)")
    q.add_argument("--out", help="write the full result as parquet here instead of printing")
    args = p.parse_args(argv)

    from vitalmart.plans.catalogue import QUERIES
    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0

    from vitalmart.session import get_session
    spark = get_session(args.master)
    if args.cmd == "load":
        from vitalmart.plans.landing_files import load
        for name in load(spark, args.landing, args.out):
            print(name)
        return 0
    if args.cmd == "build":
        from vitalmart.plans.star import mart
        m = mart(spark, args.sf).build()
        print(m.root)
        return 0
    if args.name not in QUERIES:
        print(f"unknown query {args.name!r}; see `python -m vitalmart list`", file=sys.stderr)
        return 2
    df = QUERIES[args.name](spark, args.sf)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
