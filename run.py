"""spark-submit entry: raw catalogue files to curated Parquet and result tables."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from ratingloom.defaults import Thresholds
from ratingloom.plans.full_run import check_run, run_all
from ratingloom.session import build_session


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="catalogue CSV")
    parser.add_argument("--tags", help="vote matrix CSV; without it there is no tag report")
    parser.add_argument("--curated", required=True, help="folder of the curated Parquet, replaced")
    parser.add_argument("--output", required=True, help="folder of the results, replaced")
    parser.add_argument("--multi-line", action="store_true", help="fields hold line breaks")
    parser.add_argument(
        "--column", action="append", default=[], metavar="DECLARED=FILE", help="a column's name in the file"
    )
    parser.add_argument(
        "--survivor", action="append", metavar="COLUMN", help="order that picks the row kept of a repeated key"
    )
    parser.add_argument("--zero-positive", choices=("score", "null"), default="score")
    parser.add_argument("--exact-median", action="store_true", help="exact medians per price band")
    parser.add_argument("--sort-unrounded", action="store_true", help="rank groups by the mean itself")
    parser.add_argument("--only-found-bands", action="store_true", help="leave out price bands without items")
    votes = parser.add_mutually_exclusive_group()
    votes.add_argument(
        "--unique-votes", dest="unique_votes", action="store_true", default=None, help="trust one matrix row per item"
    )
    votes.add_argument(
        "--repeated-votes", dest="unique_votes", action="store_false", help="combine matrix rows by item, unchecked"
    )
    parser.add_argument("--audit", action="store_true", help="count cells that do not parse, and list them")
    parser.add_argument("--check", action="store_true", help="check the written results; exit 1 on a violation")
    parser.set_defaults(unique_votes=None)
    for field in fields(Thresholds):
        parser.add_argument(f"--{field.name.replace('_', '-')}", type=int, default=field.default)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = build_session("catalogue-run")
    thresholds = Thresholds(**{f.name: getattr(args, f.name) for f in fields(Thresholds)})
    written = run_all(
        spark,
        args.input,
        args.curated,
        args.output,
        tags_path=args.tags,
        thresholds=thresholds,
        order=args.survivor,
        multi_line=args.multi_line,
        names=dict(pair.split("=", 1) for pair in args.column),
        zero_positive=args.zero_positive,
        all_bands=not args.only_found_bands,
        exact_median=args.exact_median,
        sort_unrounded=args.sort_unrounded,
        unique_votes=args.unique_votes,
        audit=args.audit,
    )
    for name, path in written.items():
        print(f"{name}: {path}")
    if not args.check:
        return 0
    found = check_run(spark, written, args.curated, thresholds).collect()
    for row in found:
        print(f"{row['check']}: {row['violations']} violations")
    return int(not all(row["passed"] for row in found))


if __name__ == "__main__":
    sys.exit(main())
