import json

from pyspark.sql import functions as F

from quietfare.operators import dashboard as D
from quietfare.queries.reference import ledger_lines
from quietfare.sources import ledger as L
from quietfare.sources import readers


def write(path, n=3):
    return [L.append(path, {"metrics": {"x": i}}, c, "me") for i, c in zip(range(n), ["fetch", "synth", "validate"], strict=False)]


def lines(spark, path):
    return readers.read_lines(spark, str(path))


def test_chain(spark, tmp_path):
    entries = write(tmp_path / "l.jsonl")
    assert entries[0]["prev_entry_hash"] == L.GENESIS and entries[2]["prev_entry_hash"] == entries[1]["entry_hash"]
    assert tuple(L.verify(lines(spark, tmp_path / "l.jsonl")).first()) == (True, 3, None, None)


def test_tampering_is_found_at_its_place(spark, tmp_path):
    path = tmp_path / "l.jsonl"
    write(path)
    text = path.read_text().splitlines()
    changed = json.loads(text[1])
    changed["metrics"]["x"] = 99
    path.write_text("\n".join([text[0], json.dumps(changed), "", text[2]]) + "\n")
    r = L.verify(lines(spark, path)).first()
    assert (r.ok, r.break_seq) == (False, 1) and "mismatch" in r.reason
    path.write_text("\n".join([text[0], text[2]]) + "\n")
    assert L.verify(lines(spark, path)).first().break_seq == 1


def test_unreadable_and_empty(spark, tmp_path):
    path = tmp_path / "l.jsonl"
    path.write_text("nonsense\n")
    assert L.verify(lines(spark, path)).first().break_seq == 0
    assert tuple(L.verify(spark.createDataFrame([], "pos bigint, line string")).first()) == (True, 0, None, None)


def test_dashboard_tables(spark):
    e = D.entries(ledger_lines(spark))
    assert D.exports(e, "2026-04").where("scope = 'month'").first().suppression_rate == 0.05
    assert D.uniqueness(e, "2026-04").count() == 2
    requests = {r.request_id: r for r in D.requests(e).collect()}
    assert requests["r1"].turnaround_hours == 2.0 and requests["r2"].exported_utc is None
    assert D.trend(D.validation(e, "2026-04"), "month", "health_score", "timestamp_utc").first().health_score == 97.25
    got = spark.createDataFrame([("month:2026-01",), ("dev",), (None,), ("other",)], "s string").select(D.month_of(F.col("s"), "2026-04"), D.scope_of(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("2026-01", "month"), ("2026-04", "dev"), (None, None), ("other", "month")]
