"""Build, load and check the star from files: ``python -m starmart --help``."""

from __future__ import annotations

import argparse

from starmart.contracts import STAR
from starmart.operators import quality
from starmart.plans import star
from starmart.session import get_or_create


def _months(named: list[str] | None) -> list[tuple[int, int]] | None:
    return [(int(y), int(m)) for y, m in (n.split("-") for n in named)] if named else None


def main(argv: list[str] | None = None) -> int:
    """0 if every check passed, else 1."""
    parser = argparse.ArgumentParser(prog="starmart", description=__doc__)
    for name in ("immigration", "temperature", "demographics", "country-lookup", "state-lookup"):
        parser.add_argument(f"--{name}", required=True, help="path of this source")
    parser.add_argument("--out", required=True, help="folder of the staged Parquet tables")
    parser.add_argument("--immigration-format", default="csv", help="any format Spark knows")
    parser.add_argument(
        "--refresh", nargs="+", metavar="MONTH", help="replace these months only: 2016-04 ..."
    )
    parser.add_argument("--rejects", help="folder for delivered rows of other months")
    parser.add_argument("--load", action="store_true", help="also load the contract tables")
    parser.add_argument("--months", nargs="*", help="load the fact of these only: 2016-04 ...")
    parser.add_argument("--publish", metavar="ROOT", help="publish the four tables as one version")
    parser.add_argument("--prefix", default="", help="prefix of the contract tables' names")
    parser.add_argument("--hive", action="store_true", help="keep tables in a Hive metastore")
    parser.add_argument("--input-bytes", type=int, help="size of the largest source")
    args = parser.parse_args(argv)

    spark = get_or_create(hive=args.hive, input_bytes=args.input_bytes)
    sources = star.Sources(
        immigration=args.immigration,
        temperature=args.temperature,
        demographics=args.demographics,
        country_lookup=args.country_lookup,
        state_lookup=args.state_lookup,
        immigration_format=args.immigration_format,
    )
    refresh = _months(args.refresh)
    tables = star.build_star(spark, sources, args.out, refresh, args.rejects)
    if args.load:
        names = star.load_star(spark, tables, args.prefix, months=_months(args.months) or refresh)
        tables = {name: spark.table(table) for name, table in names.items()}
    if args.publish:
        months = _months(args.months) or refresh
        version = star.publish_star(spark, tables, args.publish, months, full_checks=True)
        print(f"published version {version}")
        tables = star.star_snapshots(spark, args.publish).read()
    # A row per table and check.
    report = quality.check_star(tables, STAR).collect()
    for row in report:
        mark = "ok    " if row["passed"] else "FAILED"
        print(f"{mark} {row['table']}: {row['check']} observed {row['observed']}")
    return 0 if all(row["passed"] for row in report) else 1


if __name__ == "__main__":
    raise SystemExit(main())
