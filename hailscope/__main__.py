"""Jobs over catalog tables: ``python -m hailscope <job> --database db …``.

setup    create the database and its tables
load     read hail files and merge them
areas    merge county and state polygons of the postcodes
subset   place the reports in states and postcode areas
compare  county and state statistics
premium  write the premium adjustments
layers   write the map layers of the worst days
cleanup  empty or drop tables
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hailscope.functions.dates import hail_files, hail_window
from hailscope.operators.upsert import merge_table
from hailscope.plans import layers, load, risk
from hailscope.plans.workflow import merge_areas, merge_comparison, merge_subsets
from hailscope.sources import tables
from hailscope.sources.geojson import write_layers
from hailscope.sources.hail_csv import read_hail_csv
from hailscope.sources.staging import release


# The file system option of a read without credentials.
ANONYMOUS = {"fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hailscope", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        p.add_argument("--database", required=True)
        for option in options:
            p.add_argument(option, required=True)
        return p

    job("setup")
    p = job("load", "--files", "--end-date")
    p.add_argument("--lookback-months", type=int, default=3)
    p.add_argument("--granularity", choices=("month", "year"), default="month")
    p.add_argument("--rejects", help="folder for rows that cannot be read")
    p.add_argument("--anonymous", action="store_true", help="read a public bucket without credentials")
    p = job("areas", "--addresses", "--divisions", "--division-areas")
    p.add_argument("--country", default="US")
    p = job("subset")
    p.add_argument("--end-date", help="place only the reports of this window, not all of them")
    p.add_argument("--lookback-months", type=int, default=3)
    job("compare").add_argument("--as-of")
    p = job("premium", "--output")
    p.add_argument("--postcode", action="append")
    p.add_argument("--country", help="only postcodes of this country")
    p.add_argument("--decisions", help="table or path of reviewers' decisions")
    p = job("layers", "--division-areas", "--output")
    p.add_argument("--postcode", action="append")
    p.add_argument("--country", help="only postcodes of this country")
    p = job("cleanup")
    for flag in ("--empty", "--empty-raw", "--drop"):
        p.add_argument(flag, action="store_true")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"hailscope {args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        _run(spark, args)
    finally:
        release(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    db = args.database

    def table(name: str):
        return spark.table(f"{db}.{name}")

    def chosen(df):
        df = df.filter(F.col("postcode").isin(args.postcode)) if args.postcode else df
        return df.filter(F.col("country") == args.country) if args.country else df

    if args.job == "setup":
        tables.ensure_tables(spark, db)
    elif args.job == "load":
        files = hail_files(args.files, args.end_date, args.lookback_months, args.granularity)
        window = hail_window(args.end_date, args.lookback_months)
        rows, rejects = load.load_hail(read_hail_csv(spark, files, ANONYMOUS if args.anonymous else None), *window)
        merge_table(spark, f"{db}.hail_raw", rows)
        if args.rejects:
            rejects.write.mode("overwrite").parquet(args.rejects)
        load.verify_hail(table("hail_raw")).show(truncate=False)
    elif args.job == "areas":
        inputs = [tables.load_table(spark, n) for n in (args.divisions, args.division_areas, args.addresses)]
        merge_areas(spark, db, *inputs, country=args.country)
    elif args.job == "subset":
        window = hail_window(args.end_date, args.lookback_months) if args.end_date else None
        merge_subsets(spark, db, window)
    elif args.job == "compare":
        merge_comparison(spark, db, args.as_of)
    elif args.job == "premium":
        fetched = risk.fetch_comparison(
            table("risk_comparison"), chosen(table("postcode_areas")), table("state_boundary")
        )
        premiums = risk.premium_adjustment(fetched)
        if args.decisions:
            premiums = risk.apply_decisions(premiums, tables.load_table(spark, args.decisions))
        premiums.write.mode("overwrite").parquet(args.output)
    elif args.job == "layers":
        worst = layers.worst_day_bulk(table("hail_state"), chosen(table("postcode_areas")))
        shown = layers.map_layers(
            table("hail_state"),
            worst,
            tables.load_table(spark, args.division_areas),
            chosen(table("postcode_areas")),
            table("state_boundary"),
        )
        write_layers(shown, args.output)
        days = layers.worst_day_states(worst, chosen(table("postcode_areas")), table("state_boundary"))
        days.write.mode("overwrite").parquet(args.output.rstrip("/") + "-days")
    else:
        tables.cleanup(spark, db, empty=args.empty, empty_raw=args.empty_raw, drop=args.drop)


if __name__ == "__main__":
    main()
