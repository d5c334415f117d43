from datetime import timedelta

import pytest

import __spark_entry__ as entry
from quietfare import schemas as S
from quietfare.operators import validate as V
from tests.trips import clean, frame


def score(spark, rows):
    return V.health(V.profile(frame(spark, rows))).first()


def test_clean_trips_score_100(spark):
    r = score(spark, clean())
    assert r.tier1_passed and r.health_score == 100.0 and not r.refused


@pytest.mark.parametrize("change", [{"PULocationID": 999}, {"hvfhs_license_num": "HV0004"}, {"pickup_datetime": None}, {"trip_time": -1}])
def test_structural_damage_is_refused(spark, change):
    rows = clean()
    rows[0] |= change
    r = score(spark, rows)
    assert not r.tier1_passed and r.health_score is None and r.refused


def counts(spark, rows, rules):
    return {r.rule: r.n for r in V.rule_counts(V.clean(frame(spark, rows)), rules).collect() if r.n}


@pytest.mark.parametrize(("change", "rule"), [({"driver_pay": -1.0}, "driver_pay_negative"), ({"wav_match_flag": "X"}, "wav_match_flag_not_YN"), ({"wav_match_flag": None}, "wav_match_flag_not_YN")])
def test_validity(spark, change, rule):
    rows = clean(20)
    rows[0] |= change
    assert counts(spark, rows, V.validity_rules()) == {rule: 1}


def test_null_flags_can_be_allowed(spark):
    rows = clean(20)
    rows[0] |= {"wav_match_flag": None}
    assert counts(spark, rows, V.validity_rules(False)) == {}


def test_consistency(spark):
    rows = clean(20)
    rows[0]["dropoff_datetime"] = rows[0]["pickup_datetime"] - timedelta(minutes=2)
    rows[1]["trip_time"] += 600
    assert counts(spark, rows, V.consistency_rules()) == {"dropoff_before_pickup": 1, "trip_time_mismatch": 2}


def test_duplicates_nulls_and_nan(spark):
    rows = clean(20)
    rows[0]["tips"] = float("nan")
    rows[1]["tips"] = None
    rows += [dict(rows[0]), dict(rows[1]), dict(rows[5])]
    r = V.profile(frame(spark, rows)).first()
    assert (r.n, r.duplicate_rows, r.null_cells) == (23, 3, 4)
    assert {x.column: x.n for x in V.null_cells(frame(spark, rows)).collect()}["tips"] == 4


def test_tuples_with_shifted_nulls_differ(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), (None, None), ("a", None)], "x string, y string")
    assert V.duplicate_rows(df, ["x", "y"]).first()[0] == 2 and V.duplicate_rows(df.limit(0), ["x", "y"]).first()[0] == 0


def test_corrupted_fifth_is_refused(spark):
    rows = clean(500)
    bad = [dict(r) for r in rows[:100]]
    for r in bad:
        r |= {"base_passenger_fare": -abs(r["base_passenger_fare"]) - 1, "dropoff_datetime": r["pickup_datetime"] - timedelta(minutes=1), "tips": None}
    r = score(spark, bad + rows[100:] + [dict(x) for x in bad])
    assert (r.validity, r.consistency, r.uniqueness, r.completeness) == (66.6667, 66.6667, 83.3333, 98.6667)
    assert r.tier1_passed and r.refused and abs(r.health_score - 78.8333) < 1e-3


def test_empty_and_missing_column(spark):
    empty = V.health(V.profile(frame(spark, []))).first()
    assert empty.health_score == 100.0
    missing = {(r.column, r.check) for r in V.contract_failures(frame(spark, clean(5)).drop("tips", "PULocationID")).collect()}
    assert missing == {("tips", "column_in_dataframe"), ("PULocationID", "column_in_dataframe")}


def test_money_profile_and_casts(spark):
    rows = clean(3)
    rows[0]["tolls"], rows[1]["tolls"], rows[2]["tolls"] = -2.0, 0.0, float("inf")
    r = next(x for x in V.money_profile(frame(spark, rows)).collect() if x.column == "tolls")
    assert (r.min, r.max, r.negatives, r.zeros) == (-2.0, 0.0, 1, 1)
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert V.uncastable(df, {"a": "int"}).first().n == 1
    assert len(S.REAL_COLUMNS) == 25 and len(S.REQUIRED_COLUMNS) == 16


@pytest.mark.parametrize(("query", "licence", "n"), [("health_gate", "HV0003", 20), ("health_gate", "HV0004", 20), ("health_gate_license", "HV0003", 20), ("health_gate_license", "HV0004", 19)])
def test_gate_sees_the_rows_that_break_the_contract(spark, tmp_path, query, licence, n):
    rows = clean(20)
    rows[0] |= {"hvfhs_license_num": licence, "trip_time": -1, "tolls": -2.0, "tips": None}
    frame(spark, rows).write.parquet(str(tmp_path / "trips.parquet"))
    r = entry.queries()[query](spark, str(tmp_path)).first()
    assert r.n == n and r.tier1_passed == (n == 19) and r.refused == (n == 20) and (r.validity == 95.0) == (n == 20)
