"""Command line: ``python -m lexmill list`` and ``python -m lexmill run NAME --tables DIR --out DIR [--format parquet|json|csv]``."""

from __future__ import annotations

import argparse

from .queries import ORACLES, QUERIES
from .session import session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries; * has SQL beside it")
    run = commands.add_parser("run", help="write a query's result")
    run.add_argument("name", choices=sorted(QUERIES))
    run.add_argument("--tables", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--format", choices=["parquet", "json", "csv"], default="parquet")
    run.add_argument("--master")
    args = parser.parse_args(argv)
    if args.command == "list":
        for name in sorted(QUERIES):
            print(name + (" *" if name in ORACLES else ""))
        return 0
    spark = session("lexmill", args.master) if args.master else session("lexmill")
    write = QUERIES[args.name](spark, args.tables).write.mode("overwrite")
    getattr(write, args.format)(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
