"""Run one batch job: ``python -m rivulet daily --readings /data/mesures --base /data/rollups``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from rivulet.functions.timegrain import GRAINS, PARIS
from rivulet.operators.counters import SLICE
from rivulet.plans.jobs import refresh_latest_counters, refresh_states, refresh_stations, refresh_summaries, run_rollup
from rivulet.schemas import STATION
from rivulet.sources.readings import scan_readings


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rivulet", description=__doc__)
    parser.add_argument("job", choices=[*GRAINS, "counters"])
    parser.add_argument("--readings", required=True, help="Parquet path of the readings")
    parser.add_argument("--base", required=True, help="folder of the rollup tables")
    parser.add_argument("--aggregated", help="Parquet path of the table that names further stations")
    parser.add_argument("--stations", help="Parquet path of a maintained station list, instead of a history search")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="reference time, naive = UTC (default: now)")
    parser.add_argument("--tz", default=PARIS)
    parser.add_argument("--slice-width", default=SLICE, help="slices a busy station is spread over, e.g. '1 minute'")
    parser.add_argument(
        "--arrivals", help="Parquet path of readings new since the last run: kept slices, day states and station list are used"
    )
    parser.add_argument("--rebuild", action="store_true", help="drop all rows first")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> str:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"rivulet-{args.job}").getOrCreate()
    as_of = args.as_of or datetime.now(timezone.utc)
    readings = scan_readings(spark, args.readings)
    if args.job == "counters":
        return refresh_latest_counters(spark, readings, args.base, as_of, args.rebuild)
    stations = spark.read.parquet(args.stations).select(STATION).distinct() if args.stations else None
    named = spark.read.parquet(args.aggregated) if args.aggregated else None
    if args.arrivals:
        arrivals = scan_readings(spark, args.arrivals)
        if args.job == "daily":
            refresh_summaries(spark, readings, arrivals, args.base, args.slice_width)
        else:
            refresh_states(spark, readings, arrivals, args.base, args.tz)
        if stations is None:
            kept = refresh_stations(spark, readings, args.base)
            stations = kept if named is None else kept.union(named.select(STATION)).distinct()
    return run_rollup(
        spark, args.job, readings, named, args.base, as_of, args.tz, args.rebuild, stations, args.slice_width, stored=bool(args.arrivals)
    )


if __name__ == "__main__":
    main()
