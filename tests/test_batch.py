import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.trips import frame, trip
from tripmart import cli, contract, export, layers, measures, pipeline, profiling, quality, rules, serving, star, storage, timing
from tripmart.functions.exact import ratio
from tripmart.month import Month
from tripmart.store import MissingInput

JAN = Month(2025, 1)


def bronze(spark, rows, month=JAN):
    return contract.conform(frame(spark, rows), month, "f.parquet", datetime(2025, 2, 1))


def flags(spark, *rows):
    return [(r["failed_rules"], r["quality_warnings"]) for r in rules.evaluate(bronze(spark, list(rows))).orderBy("driver_pay", "PULocationID").collect()]


def test_month():
    assert Month.parse("2025-12").following == Month(2026, 1) and str(Month(2024, 3)) == "2024-03" and Month(2024, 12) < JAN
    for bad in ("2025-13", "2025-1", "x"):
        with pytest.raises(ValueError):
            Month.parse(bad)


def test_contract(spark):
    raw = frame(spark, [trip()])
    short = raw.drop("cbd_congestion_fee").select(*reversed([c for c in raw.columns if c != "cbd_congestion_fee"]))
    got = contract.conform(short, JAN, "a.parquet")
    assert got.columns == [*contract.NAMES, "_source_file", "_ingested_at", "data_month"] and got.first()["cbd_congestion_fee"] is None
    with pytest.raises(contract.ContractError, match="surprise"):
        contract.conform(raw.withColumn("surprise", F.lit(1)), JAN, "a.parquet")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        contract.conform(raw.withColumn("trip_miles", F.lit("far")), JAN, "a.parquet").collect()


@pytest.mark.parametrize(
    "changes,rule",
    [
        ({"driver_pay": None}, "Q001"), (
            {"pickup_datetime": datetime(2025, 2, 1), "dropoff_datetime": datetime(2025, 2, 2)}, "Q002"
        ), ({"dropoff_datetime": datetime(2025, 1, 1, 8)}, "Q003"), ({"base_passenger_fare": -0.01}, "Q004"),
        ({"driver_pay": -1.0}, "Q005"), ({"trip_time": -1}, "Q006"), ({"DOLocationID": 266}, "Q007"), ({"PULocationID": 0}, "Q007"),
        (
            {"request_datetime": datetime(2025, 1, 1, 9)}, "W001"
        ), ({"trip_miles": 0.0}, "W002"), ({"base_passenger_fare": 0.0}, "W003"), ({"trip_time": 21601}, "W004"),
    ],
)
def test_each_rule_alone(spark, changes, rule):
    failed, warned = flags(spark, trip(**changes))[0]
    assert failed + warned == [rule]


def test_rules_together(spark):
    assert flags(spark, trip(trip_time=21600, DOLocationID=265)) == [([], [])]
    assert flags(spark, trip(pickup_datetime=None, dropoff_datetime=None))[0] == (["Q001"], [])
    assert flags(spark, trip(base_passenger_fare=-1.0, driver_pay=-1.0, trip_miles=0.0))[0] == (["Q004", "Q005"], ["W002"])
    # twins warn each other, even where one is rejected or the key holds nulls
    assert [w for _, w in flags(spark, trip(), trip(driver_pay=-3.0), trip(5))] == [["W005"], ["W005"], []]
    assert [w for _, w in flags(spark, trip(PULocationID=None), trip(PULocationID=None))] == [["W005"], ["W005"]]
    assert rules.with_shared_identity(bronze(spark, [trip(), trip()]), broadcast_keys=0).select(rules.SHARED).first()[0] == 2


def test_rule_counts_always_have_all_rules(spark):
    got = rules.counts(rules.evaluate(bronze(spark, [trip(i) for i in range(5)] + [trip(9, driver_pay=-1.0)])))
    assert got.count() == 12 and {r["rule_id"]: r["matched_rows"] for r in got.collect()}["Q005"] == 1 and got.first()["total_rows"] == 6


def dims(spark):
    zones = spark.createDataFrame(
        [(1, 1, "Old", "Gate", None, date(2024, 1, 1)), (1, 1, "New", "Gate", "Airports", date(2024, 6, 1)), (2, 2, "Old", "Pier", "EWR", date(2024, 1, 1))],
        "zone_key int, location_id int, borough string, zone string, service_zone string, first_loaded date"
    )
    companies = spark.createDataFrame(
        [(1, "HV0012", "Lark", date(2024, 1, 1), None)],
        "company_key bigint, hvfhs_license_num string, company_name string, first_loaded date, removed_on date"
    )
    return zones, companies


def test_zone_versions_do_not_multiply_trips(spark):
    rows = layers.with_zone_names(bronze(spark, [trip(0), trip(1, PULocationID=77)]), dims(spark)[0])
    assert sorted((r["PULocationID"], r["pickup_borough"]) for r in rows.collect()) == [(1, "New"), (77, None)]


def test_aggregates(spark):
    zones, companies = dims(spark)
    rows = [trip(0), trip(0, trip_miles=8.25, tips=None, driver_pay=10.0), trip(1, hvfhs_license_num="HV9999", trip_miles=0.0, trip_time=0)]
    ok = layers.silver(layers.with_zone_names(rules.evaluate(bronze(spark, rows)), zones))
    day = {r["company"]: r for r in layers.daily_company_trips(ok, companies).collect()}
    assert day["Lark"]["passenger_paid_total"] == 57.1 and day["Lark"]["avg_trip_miles"] == 6.25 and day["Lark"]["avg_trip_minutes"] == 30.0
    eco = {r["company"]: r for r in layers.monthly_driver_economics(ok, companies).collect()}
    assert eco["Lark"]["driver_pay_per_mile"] == 2.12 and eco["Other (HV9999)"]["driver_pay_per_mile"] is None
    assert layers.with_company(spark.createDataFrame([(None,)], "hvfhs_license_num string"), companies).first()["company"] == "Unknown"
    assert layers.hourly_pickup_zones(ok).agg(F.sum("trips")).first()[0] == 3
    assert layers.daily_company_trips(ok.limit(0), companies).count() == 0


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(1005, 1000), (-1005, 1000), (5, 0), (5, -1), (None, 1)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 2)).collect()] == [1.01, -1.01, None, None, None]


def test_trip_keys(spark):
    rows = bronze(spark, [trip(0)] * 3 + [trip(1), trip(2, shared_request_flag=None), trip(2, shared_match_flag=None)])
    keys = [r[0] for r in star.with_trip_key(rows).select("trip_key").collect()]
    assert len(set(keys)) == 6 and set(keys) == {r[0] for r in star.with_trip_key(rows.repartition(5)).select("trip_key").collect()}


def test_facts_and_hourly(spark):
    times = [
        {"request_datetime": datetime(2025, 1, 1, 7, 55)}, {"request_datetime": datetime(2025, 1, 1, 8)},
        {"request_datetime": datetime(2025, 1, 1, 8, 2)}, {"request_datetime": None}
    ]
    facts = star.fct_trips(bronze(spark, [trip(0, cbd_congestion_fee=None, driver_pay=float(i), **t) for i, t in enumerate(times)]))
    assert [r["wait_time_seconds"] for r in facts.orderBy("driver_pay").collect()] == [300, 0, None, None]
    assert facts.first()["total_fare"] == 28.05 and facts.first()["date_key"] == 20250101
    h = star.fct_trips_hourly(facts).first()
    assert (h["trips"], h["wait_time_seconds_sum"], h["wait_time_trips"], h["cbd_congestion_fee_sum"], h["total_fare_sum"]) == (4, 300, 2, None, 112.2)


def test_dimensions(spark):
    days = star.dim_date(spark)
    assert days.count() == 1461 and days.where("date_key = 20240229").first()["day_name"] == "Thursday" and days.where("is_weekend").count() == sum(
        date.fromordinal(date(2024, 1, 1).toordinal() + i).weekday() >= 5 for i in range(1461)
    )
    assert star.dim_time(spark).where("is_peak_hour").count() == 7
    star.check_calendar(Month(2027, 12))
    with pytest.raises(star.CalendarError):
        star.check_calendar(Month(2028, 1))
    company = star.dim_company(dims(spark)[1], bronze(spark, [trip(), trip(hvfhs_license_num="HV7"), trip(hvfhs_license_num=None)]))
    assert {(r["hvfhs_license_num"], r["company_name"]) for r in company.collect()} == {("HV0012", "Lark"), ("HV7", "Other (HV7)")}


def test_each_star_check_can_fail(spark):
    facts = star.fct_trips(bronze(spark, [trip(i) for i in range(4)]))
    keys = {"date_key": (star.dim_date(spark), "date_key"), "time_key": (star.dim_time(spark).where("hour <> 8"), "time_key")}
    failed = lambda *a: [r["name"] for r in star.checks(*a).where("not passed").collect()]
    assert failed(5, facts.unionAll(facts.limit(1)), star.fct_trips_hourly(facts), keys) == [
        "trip keys are unique", "hourly trips add up to facts", "time_key finds its dimension row"
    ]
    assert failed(3, facts, star.fct_trips_hourly(facts), {"date_key": keys["date_key"]}) == ["accepted trips are facts"]


COUNTS = "data_month date, rule_id string, severity string, description string, matched_rows bigint, total_rows bigint"


def test_spikes_and_monthly_quality(spark):
    m = [date(2025, i, 1) for i in (1, 3, 4)]
    counts = spark.createDataFrame(
        [
            (m[0], "A", "w", "d", 2, 10000), (m[1], "A", "w", "d", 300, 10000), (m[2], "A", "w", "d", 150, 10000),
            (m[0], "B", "w", "d", 0, 10000), (m[1], "B", "w", "d", 100, 10000), (m[2], "B", "w", "d", 99, 100)
        ],
        COUNTS
    )
    rates = quality.rule_rates(counts)
    assert {(r["data_month"], r["rule_id"]) for r in quality.spikes(rates).collect()} == {(m[1], "A"), (m[1], "B")}
    assert rates.where("rule_id = 'B' AND is_spike").first()["rate_vs_previous_month"] is None
    bad = spark.createDataFrame([(m[0],), (m[0],)], "data_month date")
    rows = serving.monthly_quality(quality.monthly_summary(counts, bad), counts).collect()
    assert [(r["rows_quarantined"], r["spike_rules"]) for r in rows] == [(2, []), (0, ["A", "B"]), (0, [])]


def test_previous_month_is_the_calendar_one(spark):
    rows = spark.createDataFrame([(date(2025, 1, 1), 100), (date(2025, 2, 1), 150), (date(2025, 4, 1), 10)], "month_start date, total_trips bigint")
    got = {r["month_start"].month: (r["trips_previous_month"], r["trip_growth"]) for r in measures.with_previous_month(rows).collect()}
    assert got == {1: (None, None), 2: (100, 0.5), 4: (None, None)}


def test_serving_refuses_what_it_cannot_answer(spark):
    eco = spark.createDataFrame([(date(2025, 1, 1), "Lark", "HV1", 5)], "data_month date, company string, hvfhs_license_num string, trips bigint")
    hourly = spark.createDataFrame(
        [(date(2025, 1, 1), 8, z, "B", "Z", n) for z, n in ((3, 5), (1, 5), (2, 9))],
        "data_month date, pickup_hour int, PULocationID int, pickup_borough string, pickup_zone string, trips bigint"
    )
    assert [r["zone_id"] for r in serving.busiest_zones(hourly, eco, "2025-01", limit=2).collect()] == [2, 1]
    assert serving.driver_economics(eco, "2025-01", company="x").count() == 0
    with pytest.raises(serving.NotServed, match="2025-01"):
        serving.driver_economics(eco, "2024-01")
    for wrong in (
        lambda: serving.driver_economics(eco, "2025-1"), lambda: serving.busiest_zones(hourly, eco, "2025-01", hour=24), lambda: serving.busiest_zones(
            hourly, eco, "2025-01", limit=51
        ), lambda: serving.daily_trips(
            eco, date(2025, 2, 1), date(2025, 1, 1)
        ), lambda: serving.daily_trips(eco, date(2025, 1, 1), date(2025, 4, 3))
    ):
        with pytest.raises(serving.BadRequest):
            wrong()
    daily = spark.createDataFrame([], "data_month date, trip_date date, company string, hvfhs_license_num string")
    assert serving.daily_trips(daily, date(2025, 1, 1), date(2025, 4, 2)).count() == 0


def test_profile_report(spark):
    rows = bronze(spark, [trip(0), trip(0), trip(1, tolls=None, PULocationID=300)])
    text = profiling.report("x", profiling.columns(rows.select("data_month", "tolls", "PULocationID")))
    assert "Rows: 3" in text and "| tolls | 1 |" in text
    d = profiling.duplicates(rows, rules.IDENTITY).first()
    assert (d["groups"], d["rows"], d["extra_rows"]) == (1, 2, 1)
    assert profiling.frequent_flags(rows, most=1).count() == 5 and profiling.timestamps(rows).first()["dropoff_not_after_pickup"] == 0


@pytest.fixture
def lake(spark, tmp_path):
    raw = tmp_path / "raw"
    rows = [trip(i, hvfhs_license_num=f"HV000{i % 3}") for i in range(40)] + [trip(50, driver_pay=-1.0)]
    frame(spark, rows).coalesce(1).write.parquet(str(raw / "fhvhv" / "fhvhv_tripdata_2025-01.parquet"))
    frame(spark, [trip(i, month=2) for i in range(7)]).drop("cbd_congestion_fee").coalesce(1).write.parquet(
        str(raw / "fhvhv" / "fhvhv_tripdata_2025-02.parquet")
    )
    (raw / "taxi_zone_lookup.csv").write_text(
        "LocationID,Borough,Zone,service_zone\n" + "".join(f"{i},B{i % 2},Z{i},{'Airports' if i == 1 else 'Boro Zone'}\n" for i in range(1, 266))
    )
    return pipeline.Lake(spark, str(tmp_path / "lake"), str(raw))


def run(lake, *argv):
    return cli.main([*argv, "--lake", lake.root, "--data", lake.raw], spark=lake.spark)


def test_commands_from_file_to_export(lake, tmp_path):
    assert run(lake, "silver", "--month", "2025-01") == 1  # nothing loaded yet
    assert run(lake, "bronze", "--month", "2025-05") == 1
    for month in ("2025-01", "2025-02", "2025-01"):
        for step in ("bronze", "silver", "gold", "star"):
            assert run(lake, step, "--month", month) == 0
    assert lake.table("silver").read().count() == 47 and lake.table("quarantine").read().count() == 1 and lake.table("rule_counts").read().count() == 24
    assert lake.table("dim_company").read().count() == 4 and lake.table("fct_trips").read().select("trip_key").distinct().count() == 47
    out = str(tmp_path / "out")
    assert run(lake, "snapshot", "--month", "2025-01", "--out", out) == 0 and run(lake, "snapshot", "--month", "2025-02", "--out", out) == 0
    export.views(lake.spark, out, list(pipeline.SERVED))
    assert lake.spark.sql("SELECT sum(rows_checked) FROM quality_months").first()[0] == 48
    with pytest.raises(FileNotFoundError):
        export.views(lake.spark, out, ["nothing"])
    assert run(lake, "export", "--out", out) == 0
    assert "trip_key" not in lake.spark.read.parquet(f"{out}/fct_trips.parquet").columns and lake.spark.read.parquet(f"{out}/dim_date.parquet").count() == 365
    assert run(lake, "profile", "--month", "2025-01", "--out", out) == 0 and (tmp_path / "out" / "fhvhv_2025-01.md").exists()


def test_a_month_that_became_clean_keeps_no_stale_quarantine(lake, spark):
    run(lake, "bronze", "--month", "2025-01"), run(lake, "silver", "--month", "2025-01")
    lake.table("bronze").replace_month(lake.month("bronze", JAN).where("driver_pay >= 0"), JAN)
    run(lake, "silver", "--month", "2025-01")
    assert lake.table("quarantine").read().count() == 0 and lake.table("silver").read().count() == 40


def test_missing_input_names_what_is_missing(lake):
    with pytest.raises(MissingInput, match="bronze"):
        lake.month("bronze", JAN)


def test_timing():
    ticks = iter(range(100))
    got = timing.measure({"a": lambda: None, "b": lambda: None}, 2, clock=lambda: next(ticks))
    assert got == {"a": [1, 1], "b": [1, 1], "total": [2, 2]} and timing.Spread.of([3, 1, 2]) == timing.Spread(2, 1, 3)
    assert "| total | 2.00 |" in timing.report("t", got)
    runs = [
        {
            "run_id": 1, "start_time": 0, "end_time": 9000, "state": {"result_state": "SUCCESS"},
            "job_parameters": [{"name": "month", "value": "2025-01"}], "tasks": [{"task_key": "x", "start_time": 1000, "end_time": 3500}]
        },
        {"run_id": 2, "state": {"result_state": "FAILED"}}
    ]
    for text in (json.dumps(runs), json.dumps({"runs": runs})):
        assert timing.job_runs(text) == [{"run_id": 1, "parameters": {"month": "2025-01"}, "tasks": {"x": 2.5}, "seconds": 9.0}]


def test_throughput(spark):
    at = datetime(2025, 1, 1)
    rows = [(at, datetime(2025, 1, 1, 0, 0, 10), 100), (at, at, 50), (at, datetime(2025, 1, 1, 0, 0, 5), 0)]
    assert timing.throughput(spark.createDataFrame(rows, "started_at timestamp, finished_at timestamp, input_rows bigint")).first()["rows_per_second"] == 10.0


def test_http_answers(lake, tmp_path):
    import json as j
    import threading
    import urllib.error
    import urllib.request

    from tripmart import http_api

    for step in ("bronze", "silver", "gold", "star"):
        assert run(lake, step, "--month", "2025-01") == 0
    assert run(lake, "snapshot", "--month", "2025-01", "--out", str(tmp_path / "snap")) == 0
    server = http_api.server(http_api.Service(lake.spark, str(tmp_path / "snap")))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    get = lambda path: j.load(urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{path}", timeout=60))
    try:
        assert get("/health")["months"] == ["2025-01-01"] and sum(r["trips"] for r in get("/drivers/economics?month=2025-01")) == 40
        assert len(get("/zones/busiest?month=2025-01&limit=3")) == 3 and get("/quality/monthly")[0]["rows_quarantined"] == 1
        assert get("/trips/daily?start=2025-01-01&end=2025-01-02") and get("/trips/daily?start=2025-01-01&end=2025-01-02&company=x") == []
        for path, status in (
            ("/drivers/economics", 422), ("/drivers/economics?month=2024-01", 404), ("/zones/busiest?month=2025-01&hour=x", 422),
            ("/trips/daily?start=1&end=2", 422), ("/x", 404)
        ):
            with pytest.raises(urllib.error.HTTPError) as error:
                get(path)
            assert error.value.code == status
    finally:
        server.shutdown()


def test_a_job_on_named_tables_of_any_storage(lake, tmp_path, spark):
    at = f"file:{lake.root}"
    argv = ["job", "--month", "2025-01", "--lake", at, "--data", f"file:{lake.raw}", "--out", f"file:{tmp_path}/serving", "--schema", "mobility"]
    assert cli.main(argv, spark=spark) == 0 and cli.main(argv, spark=spark) == 0
    assert spark.sql("SELECT count(*) FROM mobility.silver").first()[0] == 40 and spark.table("mobility.fct_trips").count() == 40
    named = pipeline.Lake(spark, at, lake.raw, schema="mobility").table("silver")
    assert named.sql_identifier() == "`mobility`.`silver`" and spark.sql(f"SELECT * FROM {named.sql_identifier()}").columns == named.read().columns
    with pytest.raises(ValueError, match="no name"):
        lake.table("silver").sql_identifier()
    assert (tmp_path / "serving" / "bi" / "fct_trips.parquet").is_file() and (tmp_path / "serving" / "snapshot" / "rule_counts").is_dir()
    assert pipeline.months_loaded(lake) == 1
    assert storage.located("s3a://bucket/lake") == "s3a://bucket/lake" and storage.located("x") == str(Path("x").absolute())


def test_reports(lake, tmp_path, capsys):
    out = str(tmp_path / "reports")
    runs = [
        {
            "run_id": 7, "start_time": 0, "end_time": 9000, "state": {"result_state": "SUCCESS"},
            "job_parameters": [{"name": "month", "value": "2025-01"}], "tasks": [{"task_key": "x", "start_time": 1000, "end_time": 3500}]
        }
    ]
    (tmp_path / "runs.json").write_text(json.dumps(runs))
    assert run(lake, "job-timings", "--runs", str(tmp_path / "runs.json"), "--out", out) == 0
    text = (tmp_path / "reports" / "job.md").read_text()
    assert "| x | 2.50 |" in text and "| 7 | month = 2025-01 | 2.5 | 9.0 |" in text and "No successful run" in timing.job_report([])
    assert run(lake, "benchmark", "--month", "2025-01", "--repeats", "1", "--out", out) == 0
    assert "Months in bronze: 1" in (tmp_path / "reports" / "benchmark_fhvhv_2025-01.md").read_text()


def test_dashboards_are_ordered(spark):
    rows = spark.createDataFrame([(2, "b", "y"), (1, "b", "x"), (1, "a", "z")], "data_month int, rule_id string, company string")
    assert [tuple(r)[:2] for r in quality.shown(rows, "rules").collect()] == [(1, "a"), (1, "b"), (2, "b")]
    assert [r["data_month"] for r in quality.shown(rows, "months").collect()] == [1, 1, 2] and quality.shown(rows, "companies").first()["company"] == "z"
