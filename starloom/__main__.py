"""Build the immigration star from the command line.

    python -m starloom --immigration s3a://raw/2016-03 s3a://raw/2016-04 ...
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from starloom.plans.star import StarSources, build_star, cleaning_report
from starloom.scratch import clear_scratch


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__.splitlines()[0])
    parser.add_argument("--immigration", nargs="+", required=True, help="monthly files or folders")
    parser.add_argument("--immigration-format", default="parquet")
    parser.add_argument("--temperature", required=True, help="comma-separated readings")
    parser.add_argument("--demographics", required=True, help="semicolon-separated cities")
    parser.add_argument("--country-codes", required=True, help="comma-separated code and name")
    parser.add_argument("--output", required=True)
    parser.add_argument("--fail-on-empty", action="store_true")
    parser.add_argument("--report", action="store_true", help="show what cleaning removes first")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("starloom").getOrCreate()
    sources = StarSources(
        immigration=tuple(args.immigration),
        temperature=args.temperature,
        demographics=args.demographics,
        country_codes=args.country_codes,
        immigration_format=args.immigration_format,
    )
    if args.report:
        cleaning_report(spark, sources).show()
    build_star(spark, sources, args.output.rstrip("/"), args.fail_on_empty).quality().show()
    clear_scratch(spark)


if __name__ == "__main__":
    main()
