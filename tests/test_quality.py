import random
import statistics
from datetime import datetime, timedelta

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quietfare.operators import quality as Q

SCHEMA = "load_id bigint, base_passenger_fare double, trip_miles double, airport_fee double, wav_request_flag string"


def loads(n=9, rows=40):
    random.seed(3)
    return [(load, 10 + random.random() * 20, 1 + random.random() * 9, random.choice([0.0, 2.5]), random.choice("YN")) for load in range(n) for _ in range(rows)]


def found(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return {tuple(r) for r in Q.load_findings(Q.load_figures(Q.value_states(df, "load_id"), "load_id"), "load_id").collect()}


def test_quiet_loads_have_no_finding(spark):
    assert found(spark, loads()) == set()


def test_each_finding(spark):
    data = loads()
    data = [(i, None if i == 0 and k % 2 else a, b, c, d) for k, (i, a, b, c, d) in enumerate(data)]
    data = [(i, a, 5.0 if i == 1 else b, c, d) for i, a, b, c, d in data]
    data = [(i, float("nan") if i == 2 and k % 8 == 0 else a, b, c, d) for k, (i, a, b, c, d) in enumerate(data)]
    data = [(i, a, b, c, "?" if i == 3 and k % 8 == 0 else d) for k, (i, a, b, c, d) in enumerate(data)]
    data = [(i, a * 3 if i == 4 else a, b, 2.5 if i == 5 else c, d) for i, a, b, c, d in data]
    got = found(spark, data)
    assert {(0, "base_passenger_fare", "null_rate"), (1, "trip_miles", "distinct_count"), (2, "base_passenger_fare", "value_range"), (3, "wav_request_flag", "pattern"), (4, "base_passenger_fare", "distribution"), (5, "airport_fee", "distribution")} <= got
    assert {x[0] for x in got} == {0, 1, 2, 3, 4, 5}


def test_figures_against_brute_force(spark):
    data = [*loads(2), (0, None, -1.0, float("inf"), None), (0, float("nan"), float("nan"), 2000.0, "x"), (7, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    figures = {(r.load_id, r.column_name): r for r in Q.load_figures(Q.value_states(df, "load_id"), "load_id").collect()}
    for load in (0, 1, 7):
        for at, column in ((1, "base_passenger_fare"), (2, "trip_miles"), (3, "airport_fee")):
            values = [r[at] for r in data if r[0] == load]
            there = [v for v in values if v is not None]
            good = [v for v in there if v == v and 0 <= v < float("inf")]
            r = figures[load, column]
            assert r.rows == len(values) and r.nulls == len(values) - len(there)
            assert r.distinct_values == len({str(v) for v in there})
            if good:
                assert abs(r.good_median - statistics.median(good)) < 1e-9 and abs(r.share - sum(v > 0 for v in good) / len(good)) < 1e-9
            else:
                assert r.good_median is None and r.share is None
            if there:
                assert abs(r.bad_share - sum(not (v == v and 0 <= v <= 1000) for v in there) / len(there)) < 1e-9


def test_states_of_two_halves_merge(spark):
    df = spark.createDataFrame(loads(), SCHEMA)
    halves = Q.value_states(df.where("trip_miles < 5"), "load_id").union(Q.value_states(df.where("trip_miles >= 5"), "load_id"))
    a = Q.load_figures(Q.merge_value_states(halves, ["load_id"]), "load_id").orderBy("load_id", "column_name").collect()
    assert a == Q.load_figures(Q.value_states(df, "load_id"), "load_id").orderBy("load_id", "column_name").collect()


def test_medians_of_any_numbers(spark):
    random.seed(9)
    values = {0: [random.choice([-1, 1]) * 10 ** random.uniform(-8, 12) for _ in range(501)], 1: [0.0, -0.0, 5e-324, 1.7e308], 2: [3.5] * 7 + [9.0], 3: [-2.0, -2.0, 4.0, 4.0], None: [1.0]}
    df = spark.createDataFrame([(k, "c", float(v), None, 1) for k, vs in values.items() for v in vs] + [(7, "c", None, None, 3), (7, "c", float("nan"), None, 2)], "g int, column_name string, num double, txt string, n bigint")
    got = {r.g: r.median for r in Q.exact_medians(df, "g", F.lit(True)).collect()}
    assert got == {k: statistics.median(vs) for k, vs in values.items()}


def test_a_check_is_data(spark):
    checks = [Q.Check("v", "short", "share", lambda v: F.length(v) < 2, Q.present, Q.Limit("too_short", "level", 0.5), True), Q.Check("v", "null_rate", "share", Q.absent, text=True)]
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "ccc"), (1, None), (2, "ddd"), (2, "e"), (2, "fff")], "load int, v string")
    figures = Q.load_figures(Q.value_states(df, "load", checks), "load", checks)
    assert {(r.load, round(r.short, 3), r.null_rate) for r in figures.collect()} == {(1, 0.667, 0.25), (2, 0.333, 0.0)}
    assert [tuple(r) for r in Q.load_findings(figures, "load", checks).collect()] == [(1, "v", "too_short")]


def test_written_states_of_earlier_loads_are_enough(spark, tmp_path):
    data = [(i, a * 3 if i == 8 else a, b, c, d) for i, a, b, c, d in loads()]
    df = spark.createDataFrame(data, SCHEMA)
    Q.value_states(df.where("load_id < 8"), "load_id").write.parquet(str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states")).unionByName(Q.value_states(df.where("load_id = 8"), "load_id"))
    got = {tuple(r) for r in Q.load_findings(Q.load_figures(Q.merge_value_states(states, ["load_id"]), "load_id"), "load_id").collect()}
    assert got == found(spark, data) and (8, "base_passenger_fare", "distribution") in got


def test_empty_table(spark):
    assert found(spark, []) == set()
    assert Q.read_profile(Q.profile_states(spark.createDataFrame([], SCHEMA), ["load_id"])).count() == 0


def test_profile_merges(spark):
    df = spark.createDataFrame([*loads(), (99, None, float("nan"), -1.0, "bad")], SCHEMA)
    states = Q.profile_states(df, ["load_id"])
    merged = {r.column_name: r for r in Q.read_profile(Q.merge_profile_states(states)).collect()}
    miles = sorted(r[2] for r in loads())
    assert merged["trip_miles"].rows == 361 and merged["trip_miles"].nans == 1 and merged["base_passenger_fare"].nulls == 1 and merged["airport_fee"].malformed == 1 and merged["wav_request_flag"].malformed == 1
    assert abs(merged["trip_miles"].p50 - statistics.median(miles)) < 0.3 and abs(merged["trip_miles"].approx_distinct - 361) < 25
    assert merged["wav_request_flag"].min_txt == "N" and merged["wav_request_flag"].p50 is None


def test_every_column_of_a_load_is_compared(spark, tmp_path):
    random.seed(5)
    begin = datetime(2026, 4, 1)
    rows = []
    for load in range(9):
        for k in range(60):
            at = begin + timedelta(days=load, minutes=random.randrange(1400))
            rows.append([load * 60 + k, load, f"B{random.randrange(10, 30):05d}", at, 300 + random.randrange(900), 5 + random.random() * 30, random.choice([0.0, 0.0, 2.5]), random.choice("YN"), "note" if k % 20 == 0 else None])
            r = rows[-1]
            r[2] = "x" if load == 1 and k % 8 == 0 else r[2]
            r[3] = begin + timedelta(days=2, minutes=random.randrange(100)) if load == 2 else at
            r[4] *= 3 if load == 3 else 1
            r[5] = None if load == 4 and k % 3 == 0 else r[5]
            r[6] = 2.5 if load == 5 else r[6]
            r[7] = "Y" if load == 6 else r[7]
            r[2] = "B00011" if load == 7 else r[2]
    df = spark.createDataFrame(rows, "record_id bigint, load_id bigint, dispatching_base_num string, pickup_datetime timestamp_ntz, trip_time bigint, driver_pay double, tips double, shared_match_flag string, support_note string")
    df.write.parquet(str(tmp_path / "trips.parquet"))
    got = {tuple(r) for r in entry.queries()["p5_found_all"](spark, str(tmp_path)).collect()}
    assert got == {
        (1, "dispatching_base_num", "malformed"), (2, "pickup_datetime", "distribution"), (3, "trip_time", "distribution"), (4, "driver_pay", "null_rate"),
        (5, "tips", "distribution"), (6, "shared_match_flag", "distribution"), (7, "dispatching_base_num", "distinct_count"),
    }
    whole = {r.column_name: r for r in entry.queries()["p5_profile_all"](spark, str(tmp_path)).collect()}
    assert set(whole) == set(df.columns) and whole["load_id"].approx_distinct == 9
