"""Batch jobs, one per analytic, writing CSV reports like the reference's jobs.

    python -m regiocast.jobs monthly-mean --summary PATH --centers PATH --start-after DATE --out PATH
    python -m regiocast.jobs top-regions  --doses PATH --start-after DATE --out PATH
                                          [--variant rdd|sql] [--n 5] [--min-points N] [--rounding trunc|half_up]
    python -m regiocast.jobs coverage     --summary PATH --population PATH --start-after DATE --out PATH
                                          --algorithm kmeans|bisecting --k K [--target-date DATE]
                                          [--variant rdd|sql] [--points rows|daily] [--fit-partitions N]
    python -m regiocast.jobs land         --table summary|centers|doses|population --src FOLDER --out PATH
                                          [--on-bad fail|quarantine] [--rejects PATH] [--by-month] [--lenient-dates]
                                          [--stream [--checkpoint PATH] [--max-files N]]

(or ``spark-submit --py-files regiocast.zip regiocast/jobs.py ...`` on a cluster)

A table is Parquet (typed, or every column a string) or a CSV feed with a
header (a path that ends in .csv); columns are taken by name, or by position
in the raw layout.  ``--sf-dir DIR`` derives the model tables from the star
schema there instead.  The target day is tomorrow in the session's time zone
unless given.  Reports are globally sorted and written with a header, as one
file with ``--single-file``; clustering results go to ``<out>/<algorithm>/<k>``.
``land`` brings a CSV feed into a typed Parquet table: all of it, or with
``--stream`` the files that no earlier run has taken.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from regiocast.functions.dates import date_label
from regiocast.plans.coverage import POINTS, coverage_clusters
from regiocast.plans.forecast import top_regions_by_forecast
from regiocast.plans.monthly_mean import monthly_mean_per_center
from regiocast.operators.regression import ROUNDINGS
from regiocast.sources import schemas, tables
from regiocast.sources.landing import ON_BAD, land, read_csv_feed, type_columns
from regiocast.sources.sinks import clusters_path, write_csv
from regiocast.streaming.landing import land_available

VARIANTS = ("rdd", "sql")

LAYOUTS = {
    "summary": (schemas.SUMMARY_RAW, schemas.SUMMARY),
    "centers": (schemas.CENTERS_RAW, schemas.CENTERS),
    "doses": (schemas.DOSES_RAW, schemas.DOSES),
    "population": (schemas.POPULATION_RAW, schemas.POPULATION),
}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of the four tables, typed; a bad or missing value fails the job."""
    raw, typed = LAYOUTS[name]
    if path.rstrip("/").endswith(".csv"):
        return type_columns(read_csv_feed(spark, path, raw, typed), typed)
    return type_columns(spark.read.parquet(path), typed, raw_schema=raw)


def monthly_mean_job(summary: DataFrame, centers: DataFrame, out: str, start_after: str, single_file: bool = False) -> str:
    write_csv(monthly_mean_per_center(summary, centers, start_after, ordered=False), out, ["date", "region"], single_file)
    return out


def top_regions_job(
    doses: DataFrame,
    out: str,
    start_after: str,
    variant: str = "rdd",
    n: int = 5,
    min_points: int | None = None,
    rounding: str | None = None,
    single_file: bool = False,
) -> str:
    """``rdd``: at least two points, truncated, best first.  ``sql``: every group, half up, date as
    dd-MM-yyyy, the forecast ascending."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    sql = variant == "sql"
    value = "predicted" if sql else "vacc_women"
    points = min_points if min_points is not None else 1 if sql else 2
    top = top_regions_by_forecast(doses, start_after, n, points, rounding or ("half_up" if sql else "trunc"), value, ordered=False)
    if sql:
        top = top.withColumnRenamed("date", "_day").withColumn("date", date_label("_day"))
        sorted_top = top.orderBy("_day", "age", value, "region").select("date", "region", "age", value)
        write_csv(sorted_top, out, single_file=single_file)
    else:
        write_csv(top, out, sort_by=["date", "age", f"{value} DESC", "region"], single_file=single_file)
    return out


def coverage_job(
    summary: DataFrame,
    population: DataFrame,
    out: str,
    start_after: str,
    algorithm: str,
    k: int,
    target_date: str | None = None,
    points: str = "rows",
    fit_partitions: int = 1,
    single_file: bool = False,
    variant: str = "rdd",
) -> str:
    """``sql``: the same rows as ``rdd``, as one file."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    single_file = single_file or variant == "sql"
    df = coverage_clusters(summary, population, start_after, target_date, k, algorithm, points=points, fit_partitions=fit_partitions)
    path = clusters_path(out, algorithm, k)
    write_csv(df, path, sort_by=["region"], single_file=single_file)
    return path


def land_job(
    spark: SparkSession,
    table: str,
    src: str,
    out: str,
    on_bad: str = "fail",
    rejects: str | None = None,
    by_month: bool = False,
    lenient_dates: bool = False,
    stream: bool = False,
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> str:
    """A feed folder into the typed table at ``out``; ``stream`` appends the files not yet taken."""
    raw, typed = LAYOUTS[table]
    if by_month and "date" not in typed.names:
        raise ValueError(f"{table} has no date to partition by")
    options = {"on_bad": on_bad, "rejects": rejects, "month_of": "date" if by_month else None, "lenient_dates": lenient_dates}
    if stream:
        land_available(spark, src, out, raw, typed, checkpoint=checkpoint, max_files_per_trigger=max_files, **options)
    else:
        land(spark, src, out, raw, typed, **options)
    return out


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="regiocast.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    inputs = {"monthly-mean": ["summary", "centers"], "top-regions": ["doses"], "coverage": ["summary", "population"]}
    for job, names in inputs.items():
        p = sub.add_parser(job)
        for name in names:
            p.add_argument(f"--{name}")
        p.add_argument("--sf-dir")
        p.add_argument("--out", required=True)
        p.add_argument("--start-after", required=True)
        p.add_argument("--single-file", action="store_true")
    p = sub.choices["top-regions"]
    p.add_argument("--variant", choices=VARIANTS, default="rdd")
    p.add_argument("--n", type=int, default=5)
    p.add_argument("--min-points", type=int)
    p.add_argument("--rounding", choices=ROUNDINGS)
    p = sub.choices["coverage"]
    p.add_argument("--algorithm", choices=["kmeans", "bisecting"], required=True)
    p.add_argument("--k", type=int, required=True)
    p.add_argument("--variant", choices=VARIANTS, default="rdd")
    p.add_argument("--target-date")
    p.add_argument("--points", choices=POINTS, default="rows")
    p.add_argument("--fit-partitions", type=int, default=1)
    p = sub.add_parser("land")
    p.add_argument("--table", choices=list(LAYOUTS), required=True)
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--on-bad", choices=ON_BAD, default="fail")
    p.add_argument("--rejects")
    p.add_argument("--by-month", action="store_true")
    p.add_argument("--lenient-dates", action="store_true")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--checkpoint")
    p.add_argument("--max-files", type=int)
    args = parser.parse_args(argv)
    if args.job == "land":
        spark = SparkSession.builder.appName("regiocast land").getOrCreate()
        return land_job(
            spark, args.table, args.src, args.out, args.on_bad, args.rejects, args.by_month, args.lenient_dates,
            args.stream, args.checkpoint, args.max_files,
        )
    missing = [f"--{n}" for n in inputs[args.job] if getattr(args, n) is None]
    if missing and not args.sf_dir:
        parser.error(f"{args.job} needs {' and '.join(missing)}, or --sf-dir")

    spark = SparkSession.builder.appName(f"regiocast {args.job}").getOrCreate()
    derived = {
        "summary": lambda: tables.summary(spark, args.sf_dir, qualified=args.job == "coverage"),
        "centers": lambda: tables.centers(spark, args.sf_dir),
        "doses": lambda: tables.doses(spark, args.sf_dir),
        "population": lambda: tables.population(spark, args.sf_dir),
    }
    frames = [read_table(spark, n, getattr(args, n)) if getattr(args, n) else derived[n]() for n in inputs[args.job]]
    if args.job == "monthly-mean":
        return monthly_mean_job(*frames, args.out, args.start_after, args.single_file)
    if args.job == "top-regions":
        return top_regions_job(*frames, args.out, args.start_after, args.variant, args.n, args.min_points, args.rounding, args.single_file)
    return coverage_job(
        *frames, args.out, args.start_after, args.algorithm, args.k, args.target_date, args.points, args.fit_partitions, args.single_file,
        args.variant,
    )


if __name__ == "__main__":
    print(main())
