import json

import pytest
from pyspark.sql import functions as F

from quietfare.operators import drift


def frame(spark, files):
    rows = [(i * 100 + j, i, j + 1, p if isinstance(p, (str, type(None))) else json.dumps(p)) for i, records in files.items() for j, p in enumerate(records)]
    return spark.createDataFrame(rows, "row_id bigint, file_id bigint, line_no int, payload string")


def manifest(spark, files, feed="f"):
    return spark.createDataFrame([(i, feed, i) for i in files], "file_id bigint, feed string, file_seq int")


@pytest.mark.parametrize(
    ("path", "field"),
    [
        ("airport_fee", "airport_fee"), ("Airport Fee Amount", "airport_fee"), ("AIRPORT_CHARGE", "airport_fee"), ("feeAirport", "airport_fee"), ("fees.airport", "airport_fee"),
        ("surcharges.apt ", "airport_fee"), ("charges.airportAccessUsd", "airport_fee"), ("apt_fee_v2", "airport_fee"), ("cbd_congestion_fee", "cbd_congestion_fee"),
        ("congestionReliefCbd", "cbd_congestion_fee"), ("surcharges.CENTRAL_DISTRICT", "cbd_congestion_fee"), ("CbdZoneFee", "cbd_congestion_fee"), ("fees.cbd_2", "cbd_congestion_fee"),
        ("airport_code", None), ("cbd_zone", None), ("fee_note", None), ("promo_fee", None), ("congestion_surcharge", None), ("captain_fee", None), ("airport_fee_note", None), ("", None),
    ],
)
def test_carried_field(spark, path, field):
    assert spark.range(1).select(drift.carried_field(F.lit(path))).first()[0] == field


def test_report(spark):
    files = {
        1: [{"airport_fee": 1.5}, {"x": 1}],
        2: [{"fees": {"airport": 1.5}}, {"cbd_fee": None}, '{"cut'],
        3: [{"fees": {"airport": "2.5"}}, {"fees": {"airport": "2.5"}}, {"fees": {"airport": 1}}, {"cbd_fee": True}],
        4: ["not json", None],
        5: [{"CBD_FEE": False}],
    }
    got = drift.drift_report(frame(spark, files), manifest(spark, files)).select("file_id", "field", "change").collect()
    assert sorted(map(tuple, got)) == [
        (2, "airport_fee", "renamed"), (2, "cbd_congestion_fee", "added"), (3, "airport_fee", "retyped"),
        (4, "airport_fee", "removed"), (4, "cbd_congestion_fee", "removed"), (5, "cbd_congestion_fee", "added"),
    ]


def test_report_has_two_changes_of_one_field(spark):
    files = {1: [{"airport_fee": 1}], 2: [{"Airport_fee": "1"}]}
    got = drift.drift_report(frame(spark, files), manifest(spark, files)).select("change", "before", "after").collect()
    assert sorted(map(tuple, got)) == [("renamed", "airport_fee", "Airport_fee"), ("retyped", "number", "string")]


def test_report_reads_the_rescue_column(spark, monkeypatch):
    files = {1: [{"airport_fee": 1, "trip_miles": 2.0}], 2: [{"Airport_fee": "1", "trip_miles": "far"}, '{"cut']}
    kept, ingest = [], drift.ingest
    monkeypatch.setattr(drift, "ingest", lambda rows, *args: kept.append(ingest(rows, *args)) or kept[-1])
    assert drift.drift_report(frame(spark, files), manifest(spark, files)).count() == 2
    inventory = {(r.file_id, r.key, r.kind, r.n) for r in drift.key_inventory(kept[0]).collect()}
    assert inventory == {(1, "airport_fee", "number", 1), (2, "Airport_fee", "string", 1), (2, "trip_miles", "string", 1)}


def test_dotted_key_beside_the_path_it_spells(spark):
    files = {1: [{"fees.airport": 1, "fees": {"airport": 2}}], 2: [{"fees": {"airport": 2}}]}
    assert drift.drift_report(frame(spark, files), manifest(spark, files)).count() == 0
    got = drift.promote(drift.ingest(frame(spark, files))).orderBy("row_id").collect()
    assert [r.airport_fee for r in got] == [2.0, 2.0] and got[0].rescued is None  # a variant keeps its keys in order


def test_fees_at_any_depth_and_in_arrays(spark):
    deep = {"a": {"b": {"c": {"d": {"airport_fee": 1.5}}}}, "empty": {}, "list": [1, 2]}
    files = {1: [{"x": 1}], 2: [deep], 3: [{"items": [{"y": 1}, {"fees": [{"airport": 2.5}]}]}]}
    assert sorted(map(tuple, drift.drift_report(frame(spark, files), manifest(spark, files)).collect())) == [
        (2, "airport_fee", "added", None, "a.b.c.d.airport_fee"), (3, "airport_fee", "renamed", "a.b.c.d.airport_fee", "items[].fees[].airport"),
    ]
    got = drift.promote(drift.ingest(frame(spark, files))).orderBy("row_id").collect()
    assert [r.airport_fee for r in got] == [None, 1.5, 2.5]
    assert [json.loads(r.rescued) for r in got] == [{"x": 1}, {"empty": {}, "list": [1, 2]}, {"items[0].y": 1}]


def test_report_of_nothing(spark):
    files = {1: [{"airport_fee": 1}]}
    assert drift.drift_report(frame(spark, files).limit(0), manifest(spark, files)).count() == 0
    assert drift.drift_report(frame(spark, files), manifest(spark, files)).count() == 0


def test_ingest_rescues_and_promotes(spark):
    rows = frame(spark, {1: [
        {"trip_miles": 2.5, "trip_time": 60, "airport_fee": "USD 2.5", "hvfhs_license_num": "HV0003", "other": [1]},
        {"trip_miles": "far", "fees": {"cbd": "1,50"}, "pickup_datetime": "2026-01-02 03:04:05"},
        {"airport_fee": True, "cbd_congestion_fee": None},
        '{"cut', None,
    ]})
    got = [r.asDict() for r in drift.promote(drift.ingest(rows)).orderBy("row_id").collect()]
    assert [r["airport_fee"] for r in got] == [2.5, None, None, None, None]
    assert [r["cbd_congestion_fee"] for r in got] == [None, 1.5, None, None, None]
    assert got[0]["trip_miles"] == 2.5 and got[0]["trip_time"] == 60 and json.loads(got[0]["rescued"]) == {"other": [1]}
    assert got[1]["trip_miles"] is None and json.loads(got[1]["rescued"]) == {"trip_miles": "far"} and str(got[1]["pickup_datetime"]) == "2026-01-02 03:04:05"
    assert json.loads(got[2]["rescued"]) == {"airport_fee": True}
    assert json.loads(got[3]["rescued"]) == {"_unreadable": '{"cut'} and not got[3]["readable"] and got[4]["rescued"] is None


def test_values_that_do_not_fit_are_rescued(spark):
    rows = frame(spark, {1: [
        {"PULocationID": 3.7, "trip_miles": True, "trip_time": "60", "hvfhs_license_num": 3, "pickup_datetime": "soon"},
        {"PULocationID": 3.0, "trip_miles": 2, "trip_time": 3e10, "DOLocationID": 3e10, "base_passenger_fare": 9007199254740993},
        {"PULocationID": None, "driver_pay": 0.1234567890123456789},
    ]})
    got = drift.ingest(rows).orderBy("row_id").collect()
    assert json.loads(got[0].rescued) == {"PULocationID": 3.7, "trip_miles": True, "trip_time": "60", "hvfhs_license_num": 3, "pickup_datetime": "soon"} and got[0].PULocationID is None
    assert (got[1].PULocationID, got[1].trip_miles, got[1].trip_time) == (3, 2.0, 30_000_000_000)
    assert set(json.loads(got[1].rescued)) == {"DOLocationID", "base_passenger_fare"} and got[2].PULocationID is None


def test_both_ways_of_promotion_agree(spark):
    rows = frame(spark, {1: [{"trip_miles": "x", "airport_fee": "$2"}, {"fees": {"airport": 1}, "b": [{"c": 1}]}, "cut", None, {"a.b": 1, "a": {"b": 2}}, {}, {"cbd_fee": None}]})
    order = lambda df: df.orderBy("row_id").collect()
    assert order(drift.promote(drift.ingest(rows))) == order(drift.promote(drift.ingest(rows, as_json=False)))


def test_report_of_every_key(spark):
    files = {1: [{"trip_miles": 1.0, "x": 1}], 2: [{"trip_miles": "far", "x": "1", "a": {"b": {"c": [{"d": {"e": 1}}]}}}, {"x": "2"}], 3: [{"x": "3", "y.z": None}]}
    got = drift.drift_report(frame(spark, files), manifest(spark, files), every_key=True).select("file_id", "field", "change").collect()
    assert sorted(map(tuple, got)) == [
        (2, "a.b.c[].d.e", "added"), (2, "trip_miles", "retyped"), (2, "x", "retyped"),
        (3, "a.b.c[].d.e", "removed"), (3, "trip_miles", "removed"), (3, "y.z", "added"),
    ]


def test_ingest_with_clashing_columns(spark):
    rows = frame(spark, {1: [{"trip_miles": 1.0}]}).withColumn("trip_miles", F.lit("old")).withColumn("rescued", F.lit("old")).withColumn("airport_fee", F.lit(9))
    got = drift.promote(drift.ingest(rows)).first()
    assert got.trip_miles == 1.0 and got.rescued is None and got.airport_fee is None


@pytest.mark.parametrize(("text", "value"), [("2.5", 2.5), (" 2.5 ", 2.5), ("$2.50", 2.5), ("USD 2.5", 2.5), ("2,50", 2.5), ("1,250.00 usd", 1250.0), ("1,250,000", 1250000.0), ("-1", -1.0), ("n/a", None), ("", None), ("2.5 miles", None)])
def test_amount(spark, text, value):
    assert spark.range(1).select(drift.amount(F.lit(text))).first()[0] == value
