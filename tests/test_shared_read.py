"""How often the monthly run reads the trips, counted in Spark's event log of a session of its own."""

import json
import subprocess
import sys
from pathlib import Path

from frames import SEPTEMBER, spans, systems, telemetry, transitions, trips, vehicles

from kerbside import schemas

TRIPS = 5000

RUN = """
import sys
sys.path.insert(0, sys.argv[1])
sys.path.insert(0, sys.argv[1] + "/tests")
from frames import SEPTEMBER
from kerbside.plans.monthly import load_inputs, write_monthly_reports
from kerbside.session import build_session
from kerbside.sources.tables import ParquetSource

spark = build_session("shared", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2",
                      spark__eventLog__enabled="true", spark__eventLog__dir=sys.argv[3],
                      spark__eventLog__rolling__enabled="false", spark__eventLog__compress="false")
tables = load_inputs(spark, {"*": ParquetSource(sys.argv[2])})
write_monthly_reports(spark, tables, SEPTEMBER, "city", sys.argv[2] + "/out", bad_coordinates=sys.argv[4])
spark.stop()
"""


def _read(spark, folder, bad: str) -> int:
    frames = {
        "trips": trips(spark, *[dict(id=i, user_id=i % 50, vehicle_id=i % 20, start_point_lat=95.0 if i == 7 else 38.9) for i in range(TRIPS)]),
        "transitions": transitions(spark, *[dict(id=i, vehicle_id=i) for i in range(20)]),
        "vehicles": vehicles(spark, *[dict(id=i) for i in range(20)]),
        "systems": systems(spark, dict(geofence_geojson='{"type":"Point","coordinates":[1,2]}')),
        "rental_spans": spans(spark, dict(started_at_ms=SEPTEMBER.start_ms, ended_at_ms=SEPTEMBER.start_ms + 1)),
        "telemetry": telemetry(spark, dict(ts_ms=SEPTEMBER.start_ms)),
        "constants": spark.createDataFrame([(407, 0, 33, 1, 5, 7, 19, 0, 0, 13, 0)], schemas.CONSTANTS),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}")
    log = folder / "log"
    log.mkdir()
    root = str(Path(__file__).resolve().parent.parent)
    subprocess.run([sys.executable, "-c", RUN, root, str(folder), str(log), bad], check=True, timeout=300, capture_output=True)
    (events,) = log.iterdir()
    tasks = [json.loads(line) for line in events.open() if '"SparkListenerTaskEnd"' in line]
    return sum(task["Task Metrics"]["Input Metrics"]["Records Read"] for task in tasks)


def test_the_trips_are_read_twice(spark, tmp_path):
    """Once for the statistics of three reports, once for the export, counts of bad coordinates included."""
    assert 2 * TRIPS <= _read(spark, tmp_path, "null") < 3 * TRIPS
