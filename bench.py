"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. All queries are
planned and run in three rounds, every row is computed, and the fastest run of each counts (the
first round pays for JVM warm-up).
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import fleet, hourly, latest, rollup, series
from rivulet.operators.changes import upsert
from rivulet.plans.catalog import all_queries
from rivulet.plans.inputs import AS_OF, AS_OF_LONG, bench_readings, load_input

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MONTH = 24 * 31
ROUNDS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def benchmarks(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Operators over one station per user, plus catalog queries over the skewed eight stations."""
    readings = bench_readings(spark, SF_DIR)
    long_readings = load_input(spark, SF_DIR, "mesures_longues")
    names = readings.select("nom_automate").distinct()
    automate = load_input(spark, SF_DIR, "automate")

    def daily(as_of: datetime = AS_OF) -> DataFrame:
        return rollup.rollup_daily(readings, names, as_of)

    def merged() -> DataFrame:
        stored = daily(datetime(2024, 1, 29)).withColumn("created_at", F.lit("2024-01-29").cast("timestamp_ntz"))
        stored = stored.withColumn("updated_at", F.col("created_at"))
        return upsert(stored, daily(), ["jour", "nom_automate"], F.lit("2024-01-31").cast("timestamp_ntz"), unique=True)

    jobs: dict[str, Callable[[], DataFrame]] = {
        "rollup_daily": daily,
        "rollup_weekly": lambda: rollup.rollup_weekly(readings, names, AS_OF),
        "rollup_monthly": lambda: rollup.rollup_monthly(long_readings, AS_OF_LONG),
        "upsert_daily": merged,
        "latest_counters": lambda: latest.latest_counters(readings, AS_OF),
        "latest_clamped": lambda: latest.latest_clamped(readings, "hauteur_cuve_traitement_pc"),
        "hourly_energy": lambda: hourly.hourly_energy(readings, AS_OF, MONTH),
        "hourly_energy_ratio": lambda: hourly.hourly_energy_ratio(readings, AS_OF, MONTH),
        "hourly_wrap_delta_all": lambda: hourly.hourly_wrap_delta_all(readings, AS_OF, MONTH),
        "hourly_pressure_medians": lambda: hourly.hourly_pressure_medians(readings, AS_OF, MONTH),
        "temperature_series": lambda: series.temperature_series(daily(), "daily"),
        "fleet_recycled_total": lambda: fleet.fleet_recycled_total(
            latest.latest_counters(long_readings, AS_OF_LONG), automate
        ),
    }
    for name in ("visible_station_counts", "user_directory", "incident_types", "replace_set_scoped", "export_rollup"):
        jobs[name] = lambda q=all_queries()[name]: q(spark, SF_DIR)
    return jobs


def main() -> None:
    spark = session()
    jobs = benchmarks(spark)
    runs: dict[str, list[float]] = {name: [] for name in jobs}
    for _ in range(ROUNDS):
        for name, build in jobs.items():
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
    seconds = {name: round(min(taken), 3) for name, taken in runs.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
