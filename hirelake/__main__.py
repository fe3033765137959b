"""Command line for the daily jobs (run with spark-submit or python -m):

    python -m hirelake first-stage --landing ROOT --out PATH [--lines]
    python -m hirelake batch --landing ROOT --out BASE --lexicon PATH --as-of YYYY-MM-DD [--lines]

``--landing`` is the landing root: one folder per site with
``year=/month=/day=`` partitions of multi-line documents, or (``--lines``) a
JSON-lines zone written by ``write_landing``. ``--addresses`` is a Parquet
table (location, lat, lon) for geocoding; ``--lexicon`` a Parquet table with
a ``term`` column. The session is whatever the cluster provides; only unset
sizing settings are filled in.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions.text import PLATFORMS
from .operators import terms
from .plans.pipeline import first_stage, run_batch
from .session import apply_defaults
from .sources.landing import read_landing_sites, read_posting_lines
from .sources.sinks import write_partitioned
from .taxonomy import taxonomy_df


def _frames(spark, args):
    if args.lines:
        return [read_posting_lines(spark, args.landing)]
    return list(read_landing_sites(spark, args.landing, args.sites.split(",")).values())


def _addresses(spark, args):
    if args.addresses:
        return spark.read.parquet(args.addresses)
    return spark.createDataFrame([], "location string, lat double, lon double")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hirelake")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("first-stage", "batch"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--sites", default=",".join(PLATFORMS))
        p.add_argument("--lines", action="store_true", help="landing zone is JSON lines (write_landing)")
        p.add_argument("--addresses", help="Parquet (location, lat, lon)")
        if name == "batch":
            p.add_argument("--lexicon", required=True, help="Parquet with a term column")
            p.add_argument("--as-of", required=True)
            p.add_argument("--pattern", default=terms.KOREAN_PATTERN)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"hirelake-{args.command}").getOrCreate()
    apply_defaults(spark)
    frames, tax, addr = _frames(spark, args), taxonomy_df(spark), _addresses(spark, args)
    if args.command == "first-stage":
        write_partitioned(first_stage(frames, tax, addr), args.out)
    else:
        run_batch(spark, frames, args.out, tax, addr, spark.read.parquet(args.lexicon), args.as_of,
                  pattern=args.pattern)


if __name__ == "__main__":
    main()
