"""A whole run from the command line.

    spark-submit ... wardline/__main__.py --tables /data/clinic --config site.csv \\
        --maps /data/maps --as-of 2020-12-31 --out /data/report

``--tables`` holds one parquet table per clinical table, ``--maps`` the files
``code_map.csv``, ``lab_map.csv`` and ``med_map.csv`` (left out: the default maps, with
``--rxnorm`` for the RxNorm rows, or ``--no-rxnorm`` for a site without them).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from wardline.operators.cohort import index_events_by_result
from wardline.plans.maps import grow_maps
from wardline.plans.report import run_report
from wardline.sources import maps, readers


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wardline", description="Cohort report of one site")
    parser.add_argument("--tables", required=True, help="folder of the clinical tables, or the catalog's database")
    parser.add_argument("--config", required=True, help="one-row CSV of the site's settings")
    parser.add_argument("--as-of", required=True, type=date.fromisoformat, help="the run's today")
    parser.add_argument("--out", required=True, help="folder for the CSV files")
    parser.add_argument("--format", choices=["parquet", "csv", "catalog"], default="parquet", help="of the tables")
    parser.add_argument("--time-zone", default="UTC", help="zone that the tables' timestamps are read in")
    parser.add_argument("--text-ids", action="store_true", help="patient ids of CSV extracts are text")
    parser.add_argument("--maps", help="folder of the site's own map files")
    parser.add_argument("--rxnorm", help="CSV med_class,code for the default medication map")
    parser.add_argument("--no-rxnorm", action="store_true", help="the site has no RxNorm codes")
    parser.add_argument("--positive-path", help="concept path whose codes are positive tests")
    parser.add_argument("--expand-labs", action="store_true", help="add concepts below mapped labs")
    parser.add_argument("--medication-root", help="add used concepts below mapped drugs, in this root")
    parser.add_argument("--positive-codes", nargs="+", help="find index events by result text instead")
    parser.add_argument("--positive-text", default="positive")
    parser.add_argument("--age-source", choices=["stored", "birth_date"], default="stored")
    parser.add_argument("--lab-min-day", type=int, default=0)
    parser.add_argument("--keep-death-dates", action="store_true", help="no correction by last fact")
    parser.add_argument("--dedupe-race", action="store_true")
    parser.add_argument("--protect-sentinels", action="store_true")
    return parser.parse_args(argv)


def read_sources(spark: SparkSession, args: argparse.Namespace) -> readers.Sources:
    if args.format == "csv":
        return readers.read_csv(spark, args.tables, args.text_ids)
    if args.format == "catalog":
        names = ("observation_fact", "visit_dimension", "patient_dimension", "concept_dimension")
        return readers.read_tables(spark, *[f"{args.tables}.{name}" for name in names])
    return readers.read_parquet(spark, args.tables)


def print_table(name: str, table: DataFrame) -> None:
    """Every row of a report table, tab-separated, below its name and columns."""
    print(f"# {name}")
    print(*table.columns, sep="\t")
    for row in table.toLocalIterator():
        print(*["" if v is None else v for v in row], sep="\t")


def main(argv: Sequence[str] | None = None) -> list[str]:
    """Run the report and return the paths of its files."""
    args = arguments(argv)
    spark = SparkSession.builder.appName("wardline").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    tables = read_sources(spark, args)
    if args.maps:
        names = ("code_map", "lab_map", "med_map")
        site_maps = maps.read_maps(spark, *[f"{args.maps}/{name}.csv" for name in names])
    else:
        rxnorm = maps.read_rxnorm_classes(spark, args.rxnorm) if args.rxnorm else not args.no_rxnorm
        site_maps = maps.default_maps(spark, rxnorm)
    site_maps = grow_maps(
        site_maps, tables, args.positive_path, args.expand_labs, args.medication_root
    )
    cfg = readers.read_config(
        spark,
        args.config,
        args.as_of,
        age_source=args.age_source,
        lab_min_day=args.lab_min_day,
        correct_death_by_last_fact=not args.keep_death_dates,
        dedupe_race=args.dedupe_race,
        protect_sentinels=args.protect_sentinels,
    )
    positives = None
    if args.positive_codes:
        positives = index_events_by_result(tables.facts, args.positive_codes, args.positive_text)
    with run_report(tables, site_maps, cfg, positives) as report:
        written = report.write(args.out)
        if cfg.output_as_columns:
            for name, table in report.tables().items():
                print_table(name, table)
    return written


if __name__ == "__main__":
    for path in main():
        print(path)
