import csv
import json
import random
import struct
from datetime import date, datetime
from pathlib import Path

import pandas as pd
import pytest
from frames import SEPTEMBER, at, spans, systems, telemetry, transitions, trips, vehicles
from test_areas import POLYGON

from kerbside import schemas
from kerbside.operators import states
from kerbside.plans.monthly import load_inputs, write_monthly_reports
from kerbside.plans.reports import incident_template, monthly_summary
from kerbside.sinks.files import write_csv_report, write_feature_collection
from kerbside.sinks.publication import Publication
from kerbside.sources.tables import JdbcSource, ParquetSource, load_table


def lines(path):
    return [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text("utf-8").splitlines()]


def test_csv_has_header_empty_nulls_and_iso_times(spark, tmp_path):
    df = spark.sql(
        """SELECT 1 AS a, cast(NULL AS double) AS b, 'é' AS c,
                  timestamp'2020-09-01 12:00:00' AS d, timestamp'2020-09-01 12:00:00.25' AS e,
                  timestamp_ntz'2020-09-01 12:00:00' AS f, cast(NULL AS timestamp) AS g"""
    )
    path = write_csv_report(df, str(tmp_path), SEPTEMBER, "users", single_file=True)
    assert Path(path).name == "2020-09_users"
    assert lines(path) == [
        "a,b,c,d,e,f,g",
        "1,,é,2020-09-01 12:00:00+00:00,2020-09-01 12:00:00.250000+00:00,2020-09-01 12:00:00,",
    ]


def test_text_comes_back_as_it_was(spark, tmp_path):
    texts = [" a ", 'x"y,z', '"', "a,b", "line\nbreak", "\\", '\\"', "tab\t", "'", "", None, "é"]
    df = spark.createDataFrame([(i, t, "end") for i, t in enumerate(texts)], "id int, plate string, last string")
    path = write_csv_report(df, str(tmp_path), SEPTEMBER, "vehicles", single_file=True)
    (part,) = Path(path).glob("part-*")
    with open(part, encoding="utf-8", newline="") as file:
        rows = list(csv.reader(file))
    assert rows == [["id", "plate", "last"], *[[str(i), t or "", "end"] for i, t in enumerate(texts)]]


def test_numbers_are_written_as_data_frames_write_them(spark, tmp_path):
    rng = random.Random(1)
    numbers = [4.0, 1e-05, 38.8, 12345678.9, 0.0005, 0.0001, 0.00012345, 9.999e-05, 1e15, 1e16, 123456789012345680.0, 2.3e-308]
    numbers += [1.7976931348623157e308, 1e100, 1e-100, 0.0, -0.0, -1.5, -2e-7, 2e23, 9007199254740993.0, 1 / 3, 0.1 + 0.2, 100.0, 9999999.999]
    numbers += [float("inf"), float("-inf"), float("nan"), None]
    numbers += [rng.uniform(0, 60) for _ in range(300)] + [rng.uniform(0, 1) * 10.0 ** rng.randint(-20, 25) for _ in range(300)]
    bits = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(300)]
    numbers += [n for n in bits if abs(n) > 2.3e-308]
    df = spark.createDataFrame(list(enumerate(numbers)), "id int, n double")
    path = write_csv_report(df, str(tmp_path), SEPTEMBER, "users", single_file=True)
    assert "\n".join(lines(path)) + "\n" == pd.DataFrame({"id": range(len(numbers)), "n": numbers}).to_csv(index=False)
    exact = spark.sql("SELECT 38.80000BD AS a, -77.03655BD AS b, cast(NULL AS decimal(8,5)) AS c, 180.00000BD AS d, 0.00001BD AS e, 7 AS f")
    assert lines(write_csv_report(exact, str(tmp_path), SEPTEMBER, "trips", single_file=True))[1] == "38.8,-77.03655,,180.0,1e-05,7"


def test_large_reports_stay_in_parts(spark, tmp_path):
    path = write_csv_report(spark.range(100).repartition(4), str(tmp_path), SEPTEMBER, "trips")
    assert len(list(Path(path).glob("part-*"))) == 4
    assert sorted(line for line in lines(path) if line != "id") == sorted(str(i) for i in range(100))


def test_incident_template_is_a_header_with_an_index_column(spark, tmp_path):
    template = incident_template(spark)
    assert template.columns == schemas.INCIDENTS.fieldNames() and template.collect() == []
    path = write_csv_report(template, str(tmp_path), SEPTEMBER, "safety", single_file=True, index=True)
    assert lines(path) == [
        ",trip_id,vehicle_id,incident_severity,electrical_vehicle_check,police_report_number,incident_notes,"
        "incident_lat,incident_lon,vehicle_incident_path,incident_time"
    ]


def test_feature_collection_file(spark, tmp_path):
    from kerbside.operators.areas import service_area

    df = systems(spark, dict(geofence_geojson=json.dumps(POLYGON)))
    path = write_feature_collection(service_area(df, "city"), str(tmp_path), SEPTEMBER)
    assert json.loads("\n".join(lines(path)))["features"][0]["geometry"] == POLYGON
    path = write_feature_collection(service_area(df, "nowhere"), str(tmp_path), SEPTEMBER)
    assert json.loads("\n".join(lines(path))) == {"type": "FeatureCollection", "features": []}
    two = systems(spark, *[dict(id=name, geofence_geojson=json.dumps(POLYGON)) for name in "ab"])
    path = write_feature_collection(service_area(two), str(tmp_path), SEPTEMBER)
    assert len(json.loads("\n".join(lines(path)))["features"]) == 2


@pytest.fixture()
def stored(spark, tmp_path):
    blocked = dict(operationality="nonoperational", operationality_reason=["blocked"])
    log = transitions(
        spark,
        dict(id=1, started_at=at("2020-08-01 00:00:00"), ended_at=at("2020-09-10 00:00:00")),
        dict(id=2, started_at=at("2020-09-10 00:00:00"), ended_at=at("2020-09-11 00:00:00"), **blocked),
        dict(id=3, vehicle_id=2, started_at=at("2020-08-01 00:00:00")),
    )
    start = SEPTEMBER.start_ms + 3_600_000
    frames = {
        "trips": trips(spark, dict(id=1), dict(id=2, user_id=2, vehicle_id=2)),
        "transitions": log,
        "vehicles": vehicles(spark, dict(id=2, chassis_number="V2"), dict(id=1, chassis_number="V1")),
        "systems": systems(spark, dict(geofence_geojson=json.dumps(POLYGON))),
        "rental_spans": spans(spark, dict(started_at_ms=start, ended_at_ms=start + 600_000)),
        "telemetry": telemetry(spark, dict(ts_ms=start + 1000)),
        "constants": spark.createDataFrame([(407, 0, 33, 1, 5, 7, 19, 0, 0, 13, 0)], schemas.CONSTANTS),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/in/{name}")
    return ParquetSource(f"{tmp_path}/in")


def test_all_seven_reports(spark, stored, tmp_path):
    tables = load_inputs(spark, {"*": stored})
    paths = write_monthly_reports(spark, tables, SEPTEMBER, "city", str(tmp_path / "out"))
    assert sorted(Path(p).name for p in paths.values()) == [
        "2020-09_safety",
        "2020-09_service_area.geojson",
        "2020-09_summary",
        "2020-09_trips",
        "2020-09_users",
        "2020-09_vehicles",
        "2020-09_waypoints",
    ]
    read = lambda name: [
        row
        for part in sorted(Path(paths[name]).glob("part-*"))
        for row in csv.DictReader(part.read_text("utf-8").splitlines())
    ]
    assert sorted(r["user_id"] for r in read("users")) == ["1", "2"]
    assert [(r["vehicle_id"], r["num_days_in_service"], r["maintenance"]) for r in read("vehicles")] == [
        ("V1", "28.0", "1.0"),
        ("V2", "29.0", ""),
    ]
    assert sorted(r["trip_id"] for r in read("trips")) == ["1", "2"]
    assert read("waypoints") == [
        {"trip_id": "1", "lat": "38.9", "lon": "-77.0", "time": "2020-09-01 01:00:01+00:00"}
    ]
    summary = read("summary")[0]
    assert (summary["total_trips"], summary["nonoperational_M"], summary["total_vehicles"]) == ("2", "1", "407")
    assert read("safety") == []
    assert not spark.catalog.listTables()


def _files(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(Path(root).rglob("part-*"))}


def test_a_failing_report_leaves_the_old_ones(spark, stored, tmp_path):
    tables = load_inputs(spark, {"*": stored})
    out = tmp_path / "out"
    write_monthly_reports(spark, tables, SEPTEMBER, "city", str(out))
    before = _files(out)
    assert len({name.split("/")[0] for name in before}) == 7
    broken = systems(spark, dict(geofence_geojson="{"))
    for _ in range(2):
        with pytest.raises(Exception, match="(?i)malformed|json"):
            write_monthly_reports(spark, tables | {"systems": broken}, SEPTEMBER, "city", str(out))
        assert _files(out) == before
    more = tables | {"trips": trips(spark, dict(id=9, user_id=5, start_point_lat=99.0))}
    paths = write_monthly_reports(spark, more, SEPTEMBER, "city", str(out), bad_coordinates="null")
    assert {line.split(",")[0] for line in lines(paths["users"])} == {"user_id", "5"}
    assert Path(paths["bad_coordinates"]).is_dir()
    write_monthly_reports(spark, tables, SEPTEMBER, "city", str(out))
    assert {name.split("/")[0] for name in _files(out)} == {name.split("/")[0] for name in before}


def test_an_interrupted_publication_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    def write(text, names="abc"):
        with Publication(spark, str(tmp_path), "x") as aside:
            for name in names:
                spark.createDataFrame([(text,)], "t string").write.text(f"{aside}/{name}")

    read = lambda name: spark.read.text(f"{tmp_path}/{name}").first()[0]
    write("old")
    calls = []

    def failing(self, source, target, rename=Publication._rename):
        calls.append(source)
        if source.endswith("/b") and len(calls) < 4:
            raise OSError("lost")
        rename(self, source, target)

    monkeypatch.setattr(Publication, "_rename", failing)
    with pytest.raises(OSError, match="lost"):
        write("new")
    assert read("a") == "new" and read("c") == "old"
    with Publication(spark, str(tmp_path), "x") as aside:
        assert [read(name) for name in "abc"] == ["new"] * 3
        spark.createDataFrame([("newest",)], "t string").write.text(f"{aside}/a")
    assert [read(name) for name in "abc"] == ["newest", "new", "new"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b", "c"]


def test_coordinates_beyond_a_hundred_degrees_and_impossible_ones(spark, stored, tmp_path):
    tables = load_inputs(spark, {"*": stored})
    start = SEPTEMBER.start_ms + 3_600_000
    far = {
        "trips": trips(spark, dict(start_point_lon=-122.4, end_point_lon=179.999999)),
        "telemetry": telemetry(spark, dict(ts_ms=start, fields='{"location":[-122.41,37.7]}')),
    }
    read = lambda path: [row for part in sorted(Path(path).glob("part-*")) for row in csv.DictReader(part.open())]
    paths = write_monthly_reports(spark, tables | far, SEPTEMBER, "city", str(tmp_path / "far"))
    assert [(r["start_lon"], r["end_lon"]) for r in read(paths["trips"])] == [("-122.4", "180.0")]
    assert [(r["lat"], r["lon"]) for r in read(paths["waypoints"])] == [("37.7", "-122.41")]
    assert "bad_coordinates" not in paths

    bad = {
        "trips": trips(spark, dict(start_point_lat=-90.1, end_point_lon=float("nan"))),
        "telemetry": telemetry(spark, dict(ts_ms=start, fields='{"location":[1e30,37.7]}')),
    }
    for part in bad:
        with pytest.raises(Exception, match="degrees beyond"):
            write_monthly_reports(spark, tables | {part: bad[part]}, SEPTEMBER, "city", str(tmp_path / "bad"))
    paths = write_monthly_reports(
        spark, tables | bad, SEPTEMBER, "city", str(tmp_path / "null"), bad_coordinates="null"
    )
    assert [(r["start_lat"], r["end_lon"]) for r in read(paths["trips"])] == [("", "")]
    assert [(r["lat"], r["lon"]) for r in read(paths["waypoints"])] == [("37.7", "")]
    assert read(paths["bad_coordinates"]) == [
        {"start_lat": "1", "start_lon": "0", "end_lat": "0", "end_lon": "1", "waypoint_lat": "0", "waypoint_lon": "1"}
    ]


def test_tables_are_checked_on_load(spark, stored, tmp_path):
    assert load_table(spark, "trips", stored).schema.fieldNames() == schemas.TRIPS.fieldNames()
    bad = str(tmp_path / "bad")
    spark.createDataFrame([("x",)], "id string").write.parquet(bad)
    source = ParquetSource(stored.root, {"vehicles": bad})
    with pytest.raises(ValueError, match="id: expected bigint, found string.*license_plate: missing"):
        load_table(spark, "vehicles", source)
    with pytest.raises(KeyError):
        load_table(spark, "unknown", stored)


def test_types_that_hold_less_are_widened(spark):
    df = trips(spark, dict(user_id=5)).selectExpr(
        "cast(id AS int) AS id", "cast(user_id AS string) AS user_id", "cast(vehicle_id AS smallint) AS vehicle_id",
        "cast(price_before_discount AS decimal(10,2)) AS price_before_discount",
        "cast(distance_in_meters AS float) AS distance_in_meters", "cast(system_date AS timestamp) AS system_date",
        "cast(billable_duration_in_seconds AS tinyint) AS billable_duration_in_seconds",
        "* EXCEPT (id, user_id, vehicle_id, price_before_discount, distance_in_meters, system_date, billable_duration_in_seconds)",
    )
    found = schemas.conform(df, "trips")
    kinds = dict(found.dtypes)
    assert kinds == dict(trips(spark, {}).dtypes) | {"user_id": "string"}
    row = found.first()
    assert (row.user_id, row.price_before_discount, row.system_date) == ("5", 1.0, date(2020, 9, 10))
    for bad in ("cast(id AS decimal(20,0)) AS id", "cast(id AS double) AS id"):
        with pytest.raises(ValueError, match="id: expected bigint"):
            schemas.conform(trips(spark, {}).selectExpr(bad, "* EXCEPT (id)"), "trips")


def test_constants_of_the_month_and_city(spark, stored, tmp_path):
    tables = load_inputs(spark, {"*": stored})
    kept = tables["constants"].selectExpr("* EXCEPT (total_vehicles)")
    of = spark.createDataFrame(
        [(1, "2020-08", "city"), (2, "2020-09", "city"), (3, "2020-09", "other")], "total_vehicles int, month string, system_id string"
    )
    constants = schemas.conform(of.join(kept), "constants")
    assert constants.columns[-2:] == ["month", "system_id"]
    blocked = states.blocked_periods(tables["transitions"], tables["systems"], tables["vehicles"], SEPTEMBER, "city")
    summary = lambda city, table: monthly_summary(tables["trips"], blocked, table, SEPTEMBER, city).collect()
    (row,) = summary("city", constants)
    assert (row.total_vehicles, row.total_trips) == (2, 2)
    assert [r.total_vehicles for r in summary("other", constants)] == [3]
    for table in (constants.union(constants), constants.where("month = '2020-08'")):
        with pytest.raises(Exception, match="constants must have one row"):
            summary("city", table)


def test_extra_columns_are_left_out(spark):
    df = vehicles(spark, dict(id=1)).selectExpr("*", "1 AS more")
    assert schemas.conform(df, "vehicles").columns == schemas.VEHICLES.fieldNames()


def test_jdbc_options_come_from_the_caller():
    source = JdbcSource(
        {"url": "jdbc:postgresql://host/db", "user": "u", "password": "p"},
        {"trips": "analytics.rentals"},
        {"trips": {"partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}},
    )
    options = source.reader_options("trips")
    assert options["dbtable"] == "analytics.rentals" and options["numPartitions"] == "4"
    assert options["preferTimestampNTZ"] == "true"
    assert source.reader_options("vehicles")["dbtable"] == "vehicles"
    assert "numPartitions" not in source.reader_options("vehicles")
