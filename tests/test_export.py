import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quietfare.functions import hashing
from quietfare.functions.temporal import bucket, seconds_between
from quietfare.operators import kanon
from quietfare.operators.zones import with_boroughs
from quietfare.plans import export as E
from quietfare.plans import reports
from quietfare.plans.policy import POLICIES, Policy, compile_policy, load_policy
from quietfare.sources import salts
from tests.trips import clean, frame

SALT = bytes(range(16))


def exported(spark, n=300):
    df = frame(spark, clean(n)).withColumn("trip_id", F.concat(F.lit("trip-"), F.monotonically_increasing_id()))
    for c in ("rider_id", "rider_phone", "rider_email", "device_id", "payment_token", "driver_license_num", "driver_name", "vehicle_plate", "vehicle_vin"):
        df = df.withColumn(c, F.lit(f"{c} value"))
    return df.withColumn("support_note", F.when(F.col("PULocationID") % 3 == 0, "Rider John at 212.555.1234"))


def zones(spark):
    return spark.createDataFrame([(i, f"Boro{i % 5}") for i in range(1, 266)], "LocationID int, Borough string")


def test_shipped_plans():
    ops = {p.stem: [s.op for s in compile_policy(load_policy(p)[0])] for p in POLICIES.glob("*.yaml")}
    assert ops == {"tlc_trip_submission": ["redact_note", "pseudonymize", "generalize_time"], "law_enforcement_extract": ["pseudonymize", "generalize_time", "select"], "mds_aggregate": ["aggregate"]}


def test_policy_blocks_must_match():
    with pytest.raises(ValueError):
        Policy("x", 1, "", "aggregate", row_level={})
    with pytest.raises(ValueError):
        Policy("x", 1, "", "other")


def test_tlc_export(spark):
    df = exported(spark)
    out = E.export(df, load_policy(POLICIES / "tlc_trip_submission.yaml")[0], SALT)
    first = out.where("support_note is not null").first()
    assert first.rider_id == hashlib.sha256(SALT + b"rider_id value").hexdigest()[:16]
    assert first.support_note == "Rider John at [REDACTED]" and first.pickup_datetime.minute % 15 == 0 and first.pickup_datetime.second == 0
    assert out.columns == df.columns and out.count() == 300


def test_le_export(spark):
    df, (policy, digest) = exported(spark, 50), load_policy(POLICIES / "law_enforcement_extract.yaml")
    out = E.export(df, policy, SALT)
    assert out.columns == ["trip_id", "PULocationID", "DOLocationID", "pickup_datetime", "dropoff_datetime", "base_passenger_fare"]


RECORD = {
    "policy_name", "policy_version", "policy_hash", "output_kind", "source", "input_hash", "requires_approval", "approval_id", "gate", "salt_fingerprint", "columns_shared", "columns_withheld",
    "generated_utc", "output_path", "output_hash", "refused", "reason", "transforms", "rows_in", "rows_out", "cells_suppressed", "k_achieved",
}


def test_release_writes_and_audits(spark, tmp_path):
    df, (policy, digest) = exported(spark, 50), load_policy(POLICIES / "tlc_trip_submission.yaml")
    r = E.release(df, policy, digest, "dev", tmp_path / "out", 99.0, salts_folder=tmp_path / "salts", input_hash="x", approval_id="a")
    assert set(r) == RECORD and r["rows_in"] == r["rows_out"] == 50 and not r["refused"]
    assert [t["op"] for t in r["transforms"]] == ["redact_note", "pseudonymize", "generalize_time"]
    with_note = df.where("support_note is not null").count()
    assert r["transforms"][0] == {"op": "redact_note", "rows_redacted": with_note, "spans_masked": with_note} and r["transforms"][2]["minutes"] == 15
    salt = salts.read_salt(tmp_path / "salts" / f"{r['salt_fingerprint']}.salt")
    assert len(salt) == 16 and spark.read.parquet(r["output_path"]).first().rider_id == hashlib.sha256(salt + b"rider_id value").hexdigest()[:16]
    assert r["output_path"].endswith("tlc_trip_submission_dev.parquet") and r["output_hash"] == E.output_hash(r["output_path"])
    assert reports.methodology_report(r) == reports.methodology_report(dict(r)) and "redact_note; rows_redacted" in reports.methodology_report(r)


def test_a_shut_gate_writes_nothing(spark, tmp_path):
    df, (policy, digest) = exported(spark, 5), load_policy(POLICIES / "law_enforcement_extract.yaml")
    for score, approval, word in ((None, "a", "score"), (89.0, "a", "score"), (99.0, None, "approval")):
        r = E.release(df, policy, digest, "dev", tmp_path / "out", score, salts_folder=tmp_path / "salts", approval_id=approval)
        assert r["refused"] and word in r["reason"] and r["output_path"] is None and r["columns_shared"] == [] and "Refused" in reports.methodology_report(r)
    assert not (tmp_path / "out").exists() and not (tmp_path / "salts").exists()


def test_release_of_an_aggregate(spark, tmp_path):
    df, (policy, digest) = exported(spark, 2000), load_policy(POLICIES / "mds_aggregate.yaml")
    r = E.release(df, policy, digest, "2026-04", tmp_path, 95.0, zones(spark))
    rows = [list(map(int, [x.trip_count]))[0] for x in spark.read.csv(r["output_path"], header=True).collect()]
    assert rows == sorted(rows, reverse=True) and r["salt_fingerprint"] == "n/a" and r["cells_out"] == len(rows) and r["rows_out"] == sum(rows)
    assert r["cells_in"] == r["cells_out"] + r["cells_suppressed"] and r["k_achieved"] == min(rows) >= 5


def test_steps_of_a_new_policy_are_audited(spark, tmp_path):
    policy = Policy("toy", 1, "", "row_level", row_level={"rollup_zone": True, "drop_columns": ["tips", "nothing"], "kanon": {"qi": ["PUBorough", "DOBorough"], "k": 40}, "select_columns": ["rider_id", "absent"]})
    r = E.release(exported(spark), policy, "h", "dev", tmp_path, 95.0, zones(spark))
    steps = {t["op"]: t for t in r["transforms"]}
    assert steps["drop_columns"] == {"op": "drop_columns", "dropped": ["tips"], "missing": ["nothing"]} and steps["select"]["columns"] == ["rider_id"]
    assert r["cells_suppressed"] == steps["kanon"]["rows_in"] - steps["kanon"]["rows_out"] == 300 - r["rows_out"] and r["k_achieved"] == steps["kanon"]["k_achieved"]


def test_reports_and_tokens(spark):
    text = reports.validation_report("x", {"n": 200}, {"refused": False, "completeness": 99.0, "validity": 98.0, "consistency": 97.0, "uniqueness": 96.0, "health_score": 97.5}, {"a": 0, "b": 3})
    assert "| b | 3 | 1.50% |" in text and "| a |" not in text and reports.percent(1, 0) == "-"
    rung = {"qi": "zone", "uniqueness": 0.5, "rows_in": 1000, "rows_out": 0, "suppressed": 1.0, "k_achieved": None}
    assert "| zone | 50.00% | 1,000 | 0 | 100.00% | - |" in reports.risk_report("x", 5, [rung])
    assert kanon.qi_columns(["PUBorough", "pickup_bucket"]) == ["pb", "quarter"]
    for wrong in ([], ["PUBorough", "nowhere"]):
        with pytest.raises(ValueError, match="choose from"):
            kanon.qi_columns(wrong)
    df = spark.createDataFrame([("a",)] * 3 + [(None,)] * 5, "q string")
    assert kanon.suppression_audit(df, ["q"], 4).first().asDict() == {"qi": ["q"], "k": 4, "rows_in": 8, "rows_out": 5, "cells_suppressed": 3, "k_achieved": 5}
    assert kanon.suppression_audit(df.limit(0), ["q"], 4).first().k_achieved is None


def test_salt_and_detector_are_required(spark):
    policy = load_policy(POLICIES / "tlc_trip_submission.yaml")[0]
    with pytest.raises(ValueError):
        E.export(exported(spark, 5), policy)
    with pytest.raises(ValueError):
        E.export(exported(spark, 5), policy, SALT, detector=None)


def test_aggregate_has_no_small_cells(spark):
    out = E.export(exported(spark, 2000), load_policy(POLICIES / "mds_aggregate.yaml")[0], zones=zones(spark))
    assert out.columns == ["PUBorough", "DOBorough", "pickup_bucket", "trip_count"] and out.agg(F.min("trip_count")).first()[0] >= 5


def test_new_policy_needs_no_code(spark):
    policy = Policy("toy", 1, "", "row_level", row_level={"pseudonymize_columns": ["rider_id"], "rollup_zone": True, "drop_columns": ["tips", "nothing"], "kanon": {"qi": ["PUBorough", "DOBorough"], "k": 2}, "select_columns": ["rider_id", "PUBorough", "absent"]})
    out = E.export(exported(spark), policy, SALT, zones(spark))
    assert out.columns == ["rider_id", "PUBorough"] and 0 < out.count() <= 300


def test_unknown_dimension(spark):
    with pytest.raises(ValueError):
        E.dimension(exported(spark, 1), "nowhere", 60)


def test_buckets_and_seconds(spark):
    rows = [(datetime(2026, 1, 1, 0, 7, 30), datetime(2026, 1, 1, 0, 7, 30, 200000)), (datetime(2026, 1, 1, 0, 29, 59), None), (None, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(bucket(F.col("a"), 15).alias("x"), seconds_between(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.x for r in got] == [datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 15), None] and abs(got[0].s - 0.2) < 1e-9 and got[1].s is None
    with pytest.raises(ValueError):
        bucket(F.col("a"), 0)


def test_zone_rollup_keeps_unknown_zones(spark):
    z = spark.createDataFrame([(1, "Manhattan"), (2, "Queens"), (2, "Queens")], "LocationID int, Borough string")
    t = spark.createDataFrame([(1, 2), (9, 1), (None, 2)], "PULocationID int, DOLocationID int").withColumn("PUBorough", F.lit("old"))
    assert sorted(map(tuple, with_boroughs(t, z).select("PUBorough", "DOBorough").collect()), key=str) == [("Manhattan", "Queens"), (None, "Manhattan"), (None, "Queens")]
    assert with_boroughs(t, z, "inner").count() == 1


def test_hashes(spark):
    import uuid

    ns = uuid.UUID("6f1d3b2a-0c4e-5a7b-9d8c-1e2f3a4b5c6d")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    got = df.select("v", hashing.pseudonym(F.col("v"), SALT).alias("p"), hashing.uuid5(ns.bytes, F.col("v")).alias("u")).collect()
    assert all(r.u == (str(uuid.uuid5(ns, r.v)) if r.v else None) or r.v is None for r in got) and got[2].p is None
    many = spark.range(300).select(F.col("id").cast("string").alias("v"))
    assert all(r.u == str(uuid.uuid5(ns, r.v)) for r in many.select("v", hashing.uuid5(ns.bytes, F.col("v")).alias("u")).collect())
    one, two = (set(r[0] for r in many.select(hashing.pseudonym(F.col("v"), s)).collect()) for s in (SALT, SALT[::-1]))
    assert not one & two
    assert hashing.content_hash(many).first() == hashing.content_hash(many.repartition(3)).first()


def test_content_hash_sees_repeated_rows(spark):
    hashed = lambda rows: hashing.content_hash(spark.createDataFrame(rows, "a string, b int")).first()
    assert hashed([("a", 1), ("a", 1), ("z", 1)]) != hashed([("b", 1), ("b", 1), ("z", 1)])
    assert hashed([("a", 1), ("z", None)]) != hashed([("a", None), ("z", 1)])
    assert hashed([("a", 1), ("z", 2)]) == hashed([("z", 2), ("a", 1)])
    assert hashed([]).rows == 0 and hashed([]) != hashed([(None, None)])
