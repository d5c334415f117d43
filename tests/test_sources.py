import hashlib
import json

from pyspark.sql import functions as F

from quietfare.functions.hashing import hash_sample
from quietfare.operators import synth, triage
from quietfare.sources import fetch, readers, sinks
from quietfare.streaming.cells import windowed_cells


def test_csv_keeps_not_available_as_text(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,N/A,x,\n")
    assert tuple(readers.read_zones_csv(spark, str(tmp_path / "z.csv")).first()) == (1, "N/A", "x", None)


def test_json_glob_and_hashes(spark, tmp_path):
    for i in range(2):
        sinks.write_json({"b": i, "a": {"c": 1}}, tmp_path / f"r_{i}.json")
    assert (tmp_path / "r_0.json").read_text().startswith('{\n  "a"')
    assert sorted(r.b for r in readers.read_json_documents(spark, str(tmp_path / "r_*.json")).collect()) == [0, 1]
    hashes = {r.file[-8:]: r.sha256 for r in readers.file_hashes(spark, str(tmp_path / "r_*.json")).collect()}
    assert hashes["r_0.json"] == hashlib.sha256((tmp_path / "r_0.json").read_bytes()).hexdigest()


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    sinks.write_parquet(df, str(tmp_path / "p"))
    sinks.write_csv(df, str(tmp_path / "c"), ["n"])
    assert readers.row_count(spark.read.parquet(str(tmp_path / "p")), "n > 1").first().n == 1
    assert [p.read_text() for p in (tmp_path / "c").glob("*.csv")] == ["n,s\n1,a\n2,b\n"]


def test_fetch_is_cached(tmp_path):
    source = tmp_path / "s.bin"
    source.write_bytes(b"x" * 3000)
    target = tmp_path / "t" / "d.bin"
    first = fetch.fetch(source.as_uri(), target)
    source.write_bytes(b"y")
    assert fetch.fetch(source.as_uri(), target) == first and first["bytes"] == 3000 and not list(target.parent.glob("*.part"))
    assert fetch.fetch(source.as_uri(), target, refresh=True)["bytes"] == 1


def test_license_filter_is_pushed_down(spark, tmp_path):
    spark.createDataFrame([("HV0003", 1), ("HV0005", 2)], "hvfhs_license_num string, n int").write.parquet(str(tmp_path / "t"))
    df = readers.read_trips(spark, str(tmp_path / "t"), "HV0003")
    assert "EqualTo(hvfhs_license_num,HV0003)" in df._jdf.queryExecution().toString() and df.count() == 1


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("v"))
    a = hash_sample(df, ["id", "v"], 20, "id").collect()
    assert a == hash_sample(df.repartition(7), ["id", "v"], 20, "id").collect() and len(a) == 20


def test_synthetic_values(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    notes = synth.notes(df, "k", 1)
    rows = notes.collect()
    assert 0.015 < len(rows) / 20000 < 0.025
    assert sorted(rows, key=lambda r: r.k) == synth.notes(df.repartition(5), "k", 1).orderBy("k").collect()
    personal = [r for r in rows if r.gold]
    assert 0.65 < len(personal) / len(rows) < 0.85
    assert all(0 <= s.start < s.end <= len(r.support_note) for r in personal for s in r.gold)
    people = synth.identities(df.limit(2000), "k", 1).select("rider_id", "vehicle_vin", "vehicle_plate").collect()
    assert all(len(r.vehicle_vin) == 17 and len(r.vehicle_plate) == 8 for r in people) and len({r.rider_id for r in people}) < 1000


def test_heldout_formats_and_slice(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.lit("old").alias("support_note"))
    held = synth.heldout_notes(df, "k").collect()
    assert len(held) == 3000 and all(s.end <= len(r.support_note) for r in held for s in r.gold)
    rows, labels = synth.dev_slice(df, "k", ["k"], 2000)
    notes = {r.k: r.support_note for r in rows.where("support_note is not null").collect()}
    assert rows.count() == 2000 and "old" not in notes.values()
    got = labels.collect()
    assert got and all(hashlib.sha256(notes[r.k][r.start : r.end].encode()).hexdigest() == r.value_hash for r in got)


def test_keywords(spark):
    got = spark.createDataFrame([(x,) for x in ["driver name", "pickup location", "home address", "wheelchair accessible", "fare amount", "weather", "driving time", None]], "f string").select(triage.field_tier(F.col("f"))).collect()
    assert [r[0] for r in got] == ["direct", "quasi", "direct", "sensitive", "safe", None, "direct", None]
    got = spark.createDataFrame([("trip counts", ["fare"]), ("police case", None), (None, ["all trips"]), ("hello", [])], "s string, f array<string>").select(triage.request_profile(F.col("s"), F.col("f"))).collect()
    assert [r[0] for r in got] == ["mds", "le", "tlc", None]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"ts": f"2026-01-01T{h:02d}:05:00", "zone": z} for h, z, n in ((1, "a", 6), (1, "b", 2), (9, "a", 1)) for _ in range(n)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = spark.readStream.schema("ts timestamp, zone string").json(str(tmp_path / "in"))
    q = windowed_cells(stream, "ts", ["zone"]).writeStream.format("memory").queryName("cells").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.zone, r.trip_count) for r in spark.table("cells").collect()] == [("a", 6)]


def test_spread_reaches_the_cores_once(spark, tmp_path):
    from quietfare.session import spread

    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert one.rdd.getNumPartitions() == 1 and spread(one).rdd.getNumPartitions() == 4
    many = spark.range(10).repartition(9)
    assert spread(many) is many and spread(one).count() == 10


def test_tables_and_manifest(spark, tmp_path):
    tables = {"a": spark.createDataFrame([(1, "x"), (2, None)], "k int, v string"), "none": spark.createDataFrame([], "k int, l array<int>")}
    got = sinks.write_tables(tables, tmp_path)
    assert {k: n for k, (_, n) in got.items()} == {"a": 2, "none": 0} and json.loads((tmp_path / "manifest.json").read_text())["a"]["rows"] == 2
    assert {tuple(r) for r in spark.read.csv(got["a"][0], header=True).collect()} == {("1", "x"), ("2", None)}


def test_file_hashes_in_chunks(spark, tmp_path):
    (tmp_path / "a file.bin").write_bytes(b"x" * 3_000_000)
    got = {r.file.rsplit("/", 1)[-1].replace("%20", " "): (r.bytes, r.sha256) for r in readers.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {"a file.bin": (3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest())}


def test_synthetic_formats(spark):
    import re
    import uuid

    df = spark.range(400).withColumnRenamed("id", "k")
    rows = synth.identities(df, "k").collect()
    assert all(uuid.UUID(r[c]).version == 4 for r in rows for c in ("trip_id", "rider_id", "device_id")) and len({r.trip_id for r in rows}) == 400
    assert all(re.fullmatch(r"[0-9a-f]{16}", r.payment_token) and re.fullmatch(r"\d{3}-\d{3}-\d{4}", r.rider_phone) for r in rows)
    assert len({r.rider_id for r in rows}) <= 80 and len({r.vehicle_vin for r in rows}) <= 50
    many = synth.notes(spark.range(20000).withColumnRenamed("id", "k"), "k").collect()
    kinds = {s.entity_type for r in many for s in r.gold}
    assert kinds == {"PERSON", "PHONE_NUMBER", "EMAIL_ADDRESS", "LOCATION", "CREDIT_CARD", "TLC_LICENSE", "NY_PLATE", "VEHICLE_VIN"} and max(len(r.gold) for r in many) == 3
    assert len({re.sub(r"[^ ]*[0-9A-Z@*x][^ ]*", "_", r.support_note) for r in many}) >= 13
    for r in many:
        for s in r.gold:
            assert r.support_note[s.start : s.end].strip() == r.support_note[s.start : s.end] != ""
    held = synth.heldout_notes(spark.range(2000).withColumnRenamed("id", "k"), "k").collect()
    assert len({tuple(s.entity_type for s in r.gold) for r in held}) >= 8
    stats = synth.stats(synth.identities(df, "k"), synth.notes(df, "k")).first()
    assert stats.rows == 400 and 0 < stats.riders <= 80


def test_fetch_month(tmp_path):
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "fhvhv_tripdata_2026-04.parquet").write_bytes(b"abc")
    got = fetch.fetch_month("2026-04", (tmp_path / "web").as_uri() + "/", tmp_path / "raw")
    assert got["month"] == "2026-04" and got["bytes"] == 3 and (tmp_path / "raw" / "fhvhv_tripdata_2026-04.parquet").exists()
    for wrong in ("2026-13", "April", "../x"):
        try:
            fetch.fetch_month(wrong, "file:///nowhere", tmp_path)
        except ValueError:
            continue
        raise AssertionError(wrong)


def test_query_binds_values(spark):
    df = spark.range(10)
    assert readers.query(spark, "SELECT count(*) AS n FROM {t} WHERE id >= :least", {"least": 7}, t=df).first().n == 3
