import json
from datetime import date

import pytest

from tripmart import contract
from tripmart.functions.names import similarity, weights
from tripmart.operators import drift

DDL = "record_id bigint, source_file string, data_month date, line_no int, payload string, record string, r int"
CONTRACT = [
    ("hvfhs_license_num", "string"), ("PULocationID", "int"), ("trip_miles", "double"), ("tips", "double"),
    ("shared_request_flag", "string"), ("pickup_datetime", "timestamp_ntz")
]
FIELDS = [n for n, _ in CONTRACT]


def base(i, **changes):
    r = {
        "hvfhs_license_num": "HV0012", "PULocationID": 10 + i % 7, "trip_miles": 2.5 + i, "tips": 0.5, "shared_request_flag": "N",
        "pickup_datetime": "2025-01-05 10:00:00"
    } | changes
    return {k: v for k, v in r.items() if v != "-"}


def raw(spark, files):
    rows, n = [], 0
    for (feed, month), records in files.items():
        for line, r in enumerate(records):
            n += 1
            rows.append((n, f"t_2025-{month:02d}_{feed}.json", date(2025, month, 1), line, r if r is None or isinstance(r, str) else json.dumps(r), "x", 0))
    return spark.createDataFrame(rows, DDL)


def changes(spark, files):
    h = drift.headers(raw(spark, files))
    a = drift.aliases(h, FIELDS)
    return h, a, sorted((r["source_file"][2:-5], r["field_name"], r["change_kind"]) for r in drift.changes(drift.resolved(h, a, FIELDS)).collect())


def test_every_kind_of_change(spark):
    files = {
        ("r1", 1): [base(i) for i in range(4)],
        ("r1", 2): [base(i, tips="-", tip_amount=0.5, extra="web") for i in range(4)],
        ("r1", 4): [base(i, Trip_Miles=str(i + 1.5), trip_miles="-", extra="web") for i in range(4)],
        ("r1", 5): [base(i, PULocationID="-") for i in range(4)],
        ("r2", 1): [base(i) for i in range(4)],
        ("r2", 2): [base(i, PULocationID=float(i)) for i in range(4)],
    }
    assert changes(spark, files)[2] == [
        ("2025-02_r1", "extra", "added"), ("2025-02_r1", "tips", "renamed"), (
            "2025-02_r2", "PULocationID", "retyped"
        ), ("2025-04_r1", "tips", "renamed"), ("2025-04_r1", "trip_miles", "renamed"), ("2025-04_r1", "trip_miles", "retyped"),
        (
            "2025-05_r1", "PULocationID", "removed"
        ), ("2025-05_r1", "extra", "removed"), ("2025-05_r1", "trip_miles", "renamed"), ("2025-05_r1", "trip_miles", "retyped"),
    ]


def test_single_records_broken_lines_and_nulls_change_nothing(spark):
    odd = [base(9, tips="-", tip_amount=1, _tmp=1), "{broken", "[1, 2]", "3", "", None, base(1, tips=None, trip_miles="2.5")]
    files = {("r1", 1): [base(i) for i in range(4)], ("r1", 2): [base(i) for i in range(8)] + odd}
    assert changes(spark, files)[2] == []
    bad = {r["source_file"]: (r["lines"], r["unreadable_lines"]) for r in drift.unreadable(raw(spark, files)).collect()}
    assert bad["t_2025-02_r1.json"] == (15, 5)


def test_half_of_the_records_is_enough_and_all_null_has_no_type(spark):
    half = [base(i, tips="-") for i in range(2)] + [base(i) for i in range(2)]
    files = {
        ("r1", 1): [base(i) for i in range(4)], ("r1", 2): half, ("r1", 3): [base(i, tips=None) for i in range(3)],
        ("r1", 4): [base(i, tips="-") for i in range(2)] + [base(0)]
    }
    assert changes(spark, files)[2] == [("2025-04_r1", "tips", "removed")]


def test_a_lookalike_beside_its_field_is_no_rename(spark):
    files = {("r1", m): [base(i, tips_pending=0.25) for i in range(3)] for m in (1, 2)} | {("r1", 3): [base(i, tips="-", tips_pending=0.25) for i in range(3)]}
    assert changes(spark, files)[2] == [("2025-03_r1", "tips", "removed")]


def test_table_in_the_contract(spark):
    records = [
        base(0), base(1, tips="-", tip_amount="$1.50"), base(2, shared_request_flag=True, pickup_datetime=1735689600),
        base(3, trip_miles="far", PULocationID="12"), "{bad", {"other": 1}
    ]
    data = raw(
        spark,
        {("r1", 1): records + [base(0)], ("r1", 2): [base(i, tips="-", tip_amount=0.5) for i in range(3)], ("r1", 3): [base(i, tips=50) for i in range(3)]}
    )
    h = drift.headers(data)
    t = drift.consistent_table(data, h, drift.aliases(h, FIELDS), CONTRACT)
    rows = {r["record_id"]: r for r in t.collect()}
    assert t.columns[4:] == [*FIELDS, "other_fields"] and len(rows) == 12
    assert rows[1]["other_fields"] is None and rows[6]["other_fields"] == '{"other":"1"}'
    assert rows[2]["tips"] == 1.5 and rows[3]["shared_request_flag"] == "Y" and str(rows[3]["pickup_datetime"]) == "2025-01-01 00:00:00"
    assert rows[4]["trip_miles"] is None and rows[4]["PULocationID"] == 12 and rows[6]["hvfhs_license_num"] is None and rows[8]["tips"] == 0.5
    assert rows[11]["tips"] == 0.5  # fifty hundredths


def test_union_schema_promotes(spark):
    h, a, _ = changes(spark, {("r1", 1): [base(0)], ("r1", 2): [base(0, trip_miles=3)], ("r1", 3): [base(0, trip_miles="3")]})
    assert {r["field_name"]: r["type"] for r in drift.union_schema(drift.resolved(h, a, FIELDS)).collect()}["trip_miles"] == "string"


def test_empty_table(spark):
    h, a, found = changes(spark, {})
    assert found == [] and a.count() == 0
    assert drift.consistent_table(raw(spark, {}), h, a, CONTRACT).count() == 0


TRIP = [f.name for f in contract.TRIP]


@pytest.mark.parametrize(
    "key,field",
    [
        ("PUlocationID", "PULocationID"), ("pu_location_id", "PULocationID"), ("black_car_fund", "bcf"),
        ("drop_off_datetime", "dropoff_datetime"), ("dropped_off_at", "dropoff_datetime"), ("tip_amount", "tips"),
        ("orig_base_num", "originating_base_num"), ("congestion_surchg", "congestion_surcharge"), ("requested_at", "request_datetime")
    ]
)
def test_the_field_a_name_resembles_most(key, field):
    telling = weights(TRIP)
    assert max(TRIP, key=lambda f: similarity(key, f, telling)) == field


def test_a_name_without_a_common_word_needs_many_files(spark):
    renamed = [base(i, tips="-", gratuity=0.4 + i / 10) for i in range(3)]
    few = {("r1", 1): [base(i) for i in range(3)], ("r1", 2): renamed}
    assert [x[1:] for x in changes(spark, few)[2]] == [("gratuity", "added"), ("tips", "removed")]
    many = {(f"r{k}", m): [base(i) for i in range(3)] for k in range(60) for m in (1, 2)} | {(f"r{k}", 3): renamed for k in range(8)}
    assert {x[1:] for x in changes(spark, many)[2]} == {("tips", "renamed")}


def test_keys_and_values_of_any_form(spark):
    rows = [
        '{"a": 1, "b": null, "c": 1.25, "d": "x, y: z", "e": true, "f": {"g": [1, "2"], "h, i: j": 1}, "k, l: m<": 2, "n`o": "p", "q": [], "": 3}',
        "{}", '{"a": 1e300, "d": null}', '{"z": 2, "y": "1.5"}'
    ]
    whole, decimal = "whole number", "decimal number"
    want = [
        {"a": whole, "b": None, "c": decimal, "d": "string", "e": "boolean", "f": "nested", "k, l: m<": whole, "n`o": "string", "q": "nested", "": whole},
        {}, {"a": decimal, "d": None}, {"z": whole, "y": "string"}
    ]
    for row, types in zip(rows, want):
        n = spark.createDataFrame([(row, "f_1_r.json", date(2025, 1, 1))] * 2, "payload string, source_file string, data_month date")
        assert {r["key"]: r["type"] for r in drift.headers(n).collect()} == types


def test_differences_are_logged_in_order_with_the_promoted_type(spark):
    h, a, _ = changes(spark, {("r1", 1): [base(0, tips=1)], ("r1", 2): [base(0, tips=1.5)], ("r1", 3): [base(0, tips="1.5")], ("r1", 4): [base(0, tips=2)]})
    log = drift.differences(drift.resolved(h, a, FIELDS)).orderBy("sequence").collect()
    assert [(r["sequence"], r["change_kind"], r["type_before"], r["type_now"], r["promoted_to"]) for r in log] == [
        (
            2, "retyped", "whole number", "decimal number", "decimal number"
        ), (3, "retyped", "decimal number", "string", "string"), (4, "retyped", "string", "whole number", "string")]


def test_a_rename_in_another_form_is_recognised(spark):
    other = [
        base(
            i, tips="-", tip_amount=f"${i}.50", pickup_datetime="-", pickup_at=1735689600 + i, shared_request_flag="-",
            shared_requested=False
        ) for i in range(3)
    ]
    files = {("r1", 1): [base(i) for i in range(3)], ("r1", 2): other, ("r2", 1): [base(i) for i in range(3)]}
    found = changes(spark, files)[2]
    assert [(f, k) for _, f, k in found] == [
        ("pickup_datetime", "renamed"), ("pickup_datetime", "retyped"), ("shared_request_flag", "renamed"),
        ("shared_request_flag", "retyped"), ("tips", "renamed"), ("tips", "retyped")
    ]
