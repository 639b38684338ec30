"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Each query is built and run to a sink that discards rows. One round warms up, then
BENCH_RUNS rounds (default 3) are timed, of which the median counts. ``plain`` holds the
times of the same results by built-in median, whole windows and a plain interval join, a
yardstick that moves with the machine; those forms keep a large key in one task.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbside.functions.columns import METERS_PER_MILE, VEHICLE_METERS_PER_MILE
from kerbside.operators import states, trips
from kerbside.session import build_session
from verification import bindings as b
from verification.queries import registry

HEADLINES = [
    "user_trip_report",
    "trip_stats_by_vehicle",
    "state_periods",
    "time_out_days",
    "vehicle_report",
    "trip_export",
    "trip_waypoints",
    "monthly_summary",
]


def plain_stats(valid, key, meters_per_mile):
    length = F.col("distance_in_meters") / meters_per_mile
    return valid.groupBy(key).agg(F.count("id"), F.mean(length), F.median(length), F.stddev_samp(length))


def plain_users(spark, sf):
    valid = trips.in_period(trips.valid_trips(b.trips(spark, sf)), "system_date", b.USER_PERIOD)
    return plain_stats(valid, "user_id", METERS_PER_MILE)


def plain_vehicles(spark, sf):
    return plain_stats(trips.valid_trips(b.trips(spark, sf)), "vehicle_id", VEHICLE_METERS_PER_MILE)


def plain_periods(spark, sf):
    log = b.transitions(spark, sf).withColumn("category", states.state_category())
    fleet = b.vehicles(spark, sf).where("vehicle_kind_name = 'Niu'").selectExpr("id AS vehicle_id")
    before = F.lag("category").over(Window.partitionBy("vehicle_id").orderBy("started_at", "id"))
    so_far = Window.partitionBy("vehicle_id", "system_id").orderBy("started_at")
    changed = log.join(fleet, "vehicle_id").withColumn("changed", (~before.eqNullSafe(F.col("category"))).cast("int"))
    return (
        changed.withColumn("period", F.sum("changed").over(so_far))
        .groupBy("vehicle_id", "system_id", "category", "period")
        .agg(F.min("started_at"), F.max("ended_at"))
    )


def plain_waypoints(spark, sf):
    spans, points = b.rental_spans(spark, sf).where("is_valid_rental = 1"), b.telemetry(spark, sf)
    during = (F.col("identifier") == F.col("deviceid")) & F.col("ts_ms").between(F.col("started_at_ms"), F.col("ended_at_ms"))
    return points.where("msgcode = 'location'").join(spans, during).select("rental_id", "ts_ms", "fields")


PLAIN = {
    "user_trip_report": plain_users,
    "trip_stats_by_vehicle": plain_vehicles,
    "state_periods": plain_periods,
    "trip_waypoints": plain_waypoints,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    timed = {("queries", name): queries[name] for name in HEADLINES} | {("plain", name): f for name, f in PLAIN.items()}
    times = {key: [] for key in timed}
    for number in range(runs + 1):
        for key, query in timed.items():
            began = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if number:
                times[key].append(time.perf_counter() - began)
    medians = {key: round(statistics.median(measured), 3) for key, measured in times.items()}
    seconds, plain = ({n: s for (kind, n), s in medians.items() if kind == wanted} for wanted in ("queries", "plain"))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plain": plain,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
