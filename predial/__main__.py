"""Command line: `python -m predial <command> …`."""

from __future__ import annotations

import argparse

from predial.plans import jobs
from predial.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="predial")
    commands = parser.add_subparsers(dest="command", required=True)

    one = commands.add_parser("profile", help="profile a file of sale prices")
    one.add_argument("path")
    one.add_argument("output")
    one.add_argument("--exact", action="store_true", help="exact quartiles")

    two = commands.add_parser("cadastre", help="build the three period tables")
    three = commands.add_parser("prices", help="build sales, rates and lookups")
    for command in (two, three):
        command.add_argument("base", help="folder of the raw files")
        command.add_argument("root", help="output folder")
        command.add_argument("--agreed-root", required=True, help="folder output must be under")
    two.add_argument("--period", action="append", required=True)
    three.add_argument("--strict-key", action="store_true")

    args = parser.parse_args()
    spark = build_session(f"predial-{args.command}")
    if args.command == "profile":
        for name, frame in jobs.run_profile(spark, args.path, args.output, exact=args.exact).items():
            print(name)
            frame.show(40, truncate=False)
    elif args.command == "cadastre":
        print(jobs.run_cadastre(spark, args.base, args.root, args.agreed_root, args.period))
    else:
        print(jobs.run_prices(spark, args.base, args.root, args.agreed_root, args.strict_key))


if __name__ == "__main__":
    main()
