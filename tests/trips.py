"""Trips for tests: a good one by default, changed by name."""

from datetime import datetime, timedelta

from tripmart.contract import TRIP, schema


def trip(n=0, *, year=2025, month=1, **changes):
    pickup = datetime(year, month, 1 + n % 27, 8, n % 60)
    row = {
        "hvfhs_license_num": "HV0012", "dispatching_base_num": "B70001", "originating_base_num": "B70001", "request_datetime": pickup - timedelta(minutes=4), "on_scene_datetime": None, "pickup_datetime": pickup, "dropoff_datetime": pickup + timedelta(minutes=30),
        "PULocationID": 1 + n % 200, "DOLocationID": 1 + 3 * n % 200, "trip_miles": 4.25, "trip_time": 1800, "base_passenger_fare": 21.0, "tolls": 0.0, "bcf": 0.6, "sales_tax": 1.7, "congestion_surcharge": 2.75, "airport_fee": 0.0, "tips": 2.0, "driver_pay": 16.5,
        "shared_request_flag": "N", "shared_match_flag": "N", "access_a_ride_flag": "N", "wav_request_flag": "N", "wav_match_flag": "N", "cbd_congestion_fee": 1.5,
    }
    row.update(changes)
    return tuple(row[f.name] for f in TRIP)


def frame(spark, rows):
    return spark.createDataFrame(rows, schema(TRIP))
