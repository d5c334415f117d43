"""Queries of the privacy pipeline over ``trips``, ``taxi_zones``, ``documents`` and ``triage_requests``, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietfare import schemas as S
from quietfare.functions import hashing, spans
from quietfare.functions.temporal import bucket, seconds_between
from quietfare.operators import dashboard, evaluate, kanon, synth, triage, validate
from quietfare.operators.zones import with_boroughs
from quietfare.plans import export as E
from quietfare.plans.policy import POLICIES, compile_policy, load_policy
from quietfare.queries.common import table
from quietfare.sources import ledger, readers

SALT = bytes.fromhex("00112233445566778899aabbccddeeff")
OTHER_SALT = bytes.fromhex("ffeeddccbbaa99887766554433221100")
TRIP_NAMESPACE = bytes.fromhex("6f1d3b2a0c4e5a7b9d8c1e2f3a4b5c6d")  # fixed value: namespace of trip ids
DEV_MONTH = "2026-04"
SAMPLE_COLUMNS = ["request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_time", "record_id"]


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "trips")


def _risk_input(spark: SparkSession, d: str) -> DataFrame:
    """The narrow projection every risk query works on."""
    t = _trips(spark, d).select("record_id", "PULocationID", "DOLocationID", "pickup_datetime", "wav_request_flag")
    t = with_boroughs(t, table(spark, d, "taxi_zones"))
    ts = F.col("pickup_datetime")
    return t.select(
        "record_id", F.col("PULocationID").alias("pu"), F.col("DOLocationID").alias("do_id"), F.col("PUBorough").alias("pb"), F.col("DOBorough").alias("db"), "wav_request_flag",
        bucket(ts, 1).alias("minute"), bucket(ts, 15).alias("quarter"), bucket(ts, 60).alias("hour"), bucket(ts, 1440).alias("day"),
    )


LADDER = {"zone x minute": ["pu", "do_id", "minute"], "zone x 15 min": ["pu", "do_id", "quarter"], "zone x 60 min": ["pu", "do_id", "hour"], "borough x 15 min": ["pb", "db", "quarter"]}


def uniqueness_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Uniqueness and k-suppression cost of four quasi-identifiers, in one scan."""
    return kanon.ladder(_risk_input(spark, d), LADDER)


def ladder_figure(spark: SparkSession, d: str) -> DataFrame:
    """Data of the uniqueness figure, in the order of its labels."""
    return dashboard.ladder_figure(uniqueness_ladder(spark, d))


def suppression_trend(spark: SparkSession, d: str) -> DataFrame:
    """Data of the suppression figure: share of trips that k-suppression of boroughs and quarters takes, per month of delivery."""
    months = table(spark, d, "trip_files").select(F.col("file_id").alias("load_id"), "month")
    trips = _trips(spark, d).select("load_id", "PULocationID", "DOLocationID", bucket(F.col("pickup_datetime"), 15).alias("quarter"))
    sized = kanon.classes(with_boroughs(trips, table(spark, d, "taxi_zones")).join(months, "load_id"), ["month", "PUBorough", "DOBorough", "quarter"])
    return dashboard.suppression_trend(sized, "month")


def detection_table(spark: SparkSession, d: str) -> DataFrame:
    """Tidy precision and recall per type."""
    return dashboard.detection(detection_scores(spark, d))


def equivalence_classes(spark: SparkSession, d: str) -> DataFrame:
    return kanon.classes(_risk_input(spark, d), ["pb", "db", "hour"])


def custom_qi_risk(spark: SparkSession, d: str) -> DataFrame:
    return kanon.risk(_risk_input(spark, d), ["pu", "hour", "wav_request_flag"])


def class_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return kanon.size_histogram(_risk_input(spark, d), ["pb", "db", "day"])


def k_suppressed_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows that survive k-suppression."""
    return kanon.suppress(_risk_input(spark, d), ["pb", "db", "day"], 5).select("record_id", "pb", "db", "day")


def class_size_per_row(spark: SparkSession, d: str) -> DataFrame:
    return kanon.class_size(_risk_input(spark, d).select("record_id", "pb", "db", "hour"), ["pb", "db", "hour"])


def mds_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Trips per borough pair and hour without small cells, by the shipped policy."""
    policy, _ = load_policy(POLICIES / "mds_aggregate.yaml")
    return E.export(_trips(spark, d), policy, zones=table(spark, d, "taxi_zones"))


def mds_cells_summary(spark: SparkSession, d: str) -> DataFrame:
    return kanon.cells_audit(_risk_input(spark, d), ["pb", "db", "hour"])


def dimension_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a time bucket and an existing column."""
    t = _trips(spark, d)
    return kanon.cells(t.select(*[E.dimension(t, x, 1440).alias(x) for x in ("dropoff_bucket", "wav_match_flag")]), ["dropoff_bucket", "wav_match_flag"])


def zone_rollup_left(spark: SparkSession, d: str) -> DataFrame:
    return with_boroughs(_trips(spark, d).select("PULocationID", "DOLocationID"), table(spark, d, "taxi_zones")).groupBy("PUBorough", "DOBorough").agg(F.count(F.lit(1)).alias("n"))


def zone_rollup_inner(spark: SparkSession, d: str) -> DataFrame:
    return with_boroughs(_trips(spark, d).select("PULocationID", "DOLocationID"), table(spark, d, "taxi_zones"), "inner").groupBy("PUBorough", "DOBorough").agg(F.count(F.lit(1)).alias("n"))


def license_filter_count(spark: SparkSession, d: str) -> DataFrame:
    return readers.row_count(readers.read_trips(spark, f"{d}/trips.parquet", S.LICENSE))


def trip_schema(spark: SparkSession, d: str) -> DataFrame:
    return readers.schema_of(_trips(spark, d))


def sql_passthrough(spark: SparkSession, d: str) -> DataFrame:
    """A parametrised SQL statement over bound tables."""
    return readers.query(spark, "SELECT hvfhs_license_num, count(*) AS n FROM {t} GROUP BY 1", t=_trips(spark, d))


def sql_parameters(spark: SparkSession, d: str) -> DataFrame:
    """A statement with a bound table and bound values."""
    return readers.query(spark, "SELECT hvfhs_license_num, count(*) AS n FROM {t} WHERE trip_time >= :least AND hvfhs_license_num <> :other GROUP BY 1", {"least": 600, "other": "HV0004"}, t=_trips(spark, d))


def notes_by_trip(spark: SparkSession, d: str) -> DataFrame:
    """The notes in the order of their trips."""
    return _trips(spark, d).where("support_note is not null").select("trip_id", "record_id", "support_note").orderBy("trip_id", "record_id")


def profile_one_pass(spark: SparkSession, d: str) -> DataFrame:
    return validate.profile(_trips(spark, d))


def health_gate(spark: SparkSession, d: str) -> DataFrame:
    """Scores and gate of all trips as delivered: rows that break the contract are counted and refuse the table."""
    return validate.health(validate.profile(_trips(spark, d)))


def health_gate_license(spark: SparkSession, d: str) -> DataFrame:
    """The same over every trip of the licence."""
    return validate.health(validate.profile(readers.read_trips(spark, f"{d}/trips.parquet", S.LICENSE)))


def health_score(spark: SparkSession, d: str) -> DataFrame:
    """Scores and gate of the licence's trips as delivered; test data break the contract, so it refuses."""
    return health_gate_license(spark, d)


def health_score_clean(spark: SparkSession, d: str) -> DataFrame:
    """The case that passes: only the licence's trips that keep the contract, NaN counted as null before they are chosen."""
    ok = validate.clean(readers.read_trips(spark, f"{d}/trips.parquet", S.LICENSE)).where(" and ".join(f"{c} is not null" for c in S.REQUIRED_COLUMNS))
    return validate.health(validate.profile(ok.where("PULocationID between 1 and 265 and DOLocationID between 1 and 265 and trip_time >= 0")))


def suppression_audits(spark: SparkSession, d: str) -> DataFrame:
    """What k-suppression takes away for two quasi-identifiers chosen by their tokens."""
    data, out = _risk_input(spark, d), []
    for tokens in (["PUBorough", "DOBorough", "pickup_bucket"], ["PULocationID", "pickup_bucket"]):
        out.append(kanon.suppression_audit(data, kanon.qi_columns(tokens), 5).withColumn("qi", F.lit(", ".join(tokens))))
    return reduce(DataFrame.unionAll, out)


def zone_day_counts(spark: SparkSession, d: str) -> DataFrame:
    """Trips per pick-up zone and day, and those without a drop-off zone: the temporal and zone counts of a month's profile."""
    day = F.date_trunc("day", F.col("pickup_datetime")).cast("timestamp_ntz").alias("day")
    return _trips(spark, d).groupBy("PULocationID", day).agg(F.count(F.lit(1)).alias("trips"), F.count_if(F.col("DOLocationID").isNull()).alias("no_dropoff_zone"))


def null_cells_by_column(spark: SparkSession, d: str) -> DataFrame:
    return validate.null_cells(_trips(spark, d))


def money_profile(spark: SparkSession, d: str) -> DataFrame:
    return validate.money_profile(_trips(spark, d))


def validity_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return validate.rule_counts(validate.clean(_trips(spark, d)), validate.validity_rules())


def consistency_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return validate.rule_counts(_trips(spark, d), validate.consistency_rules())


def contract_failures(spark: SparkSession, d: str) -> DataFrame:
    return validate.contract_failures(_trips(spark, d))


def duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    return validate.duplicate_rows(_trips(spark, d), [c for c in S.REAL_COLUMNS + S.IDENTITY_COLUMNS])


def uncastable_values(spark: SparkSession, d: str) -> DataFrame:
    return validate.uncastable(_trips(spark, d), {"driver_license_num": "bigint", "rider_phone": "bigint", "vehicle_plate": "int"})


def pseudonymized_ids(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).select("record_id", *[hashing.pseudonym(F.col(c), SALT).alias(c) for c in ("rider_id", "rider_phone", "driver_name")])


def salt_disjointness(spark: SparkSession, d: str) -> DataFrame:
    """Pseudonyms that two salts share: none."""
    riders = _trips(spark, d).select("rider_id").distinct()
    a, b = (riders.select(hashing.pseudonym(F.col("rider_id"), s).alias("p")) for s in (SALT, OTHER_SALT))
    return a.join(b, "p", "left_semi").agg(F.count(F.lit(1)).alias("shared"))


def value_hashes(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).select("record_id", F.sha2("vehicle_vin", 256).alias("value_hash"))


def salt_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1).select(F.sha2(F.unhex(F.lit(SALT.hex())), 256).alias("fingerprint"))


def uuid5_trip_ids(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat_ws("|", "PULocationID", "DOLocationID", "trip_time", "record_id")
    return _trips(spark, d).select("record_id", hashing.uuid5(TRIP_NAMESPACE, key).alias("surrogate_id"))


def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """The 500 trips with the smallest key: the sample is the feature."""
    return hashing.hash_sample(_trips(spark, d).select(*SAMPLE_COLUMNS), SAMPLE_COLUMNS, 500, "record_id")


def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return hashing.content_hash(_trips(spark, d).select(*S.REAL_COLUMNS))


def content_hash_changes(spark: SparkSession, d: str) -> DataFrame:
    """Whether the content hash of all trips stays the same under changes of order, of one value, of which rows are repeated, and of one row's count."""
    t = _trips(spark, d).select("record_id", *S.REAL_COLUMNS)
    first = F.col("record_id") == t.agg(F.min("record_id")).scalar()
    odd, even = (t.unionAll(t.where(f"record_id % 2 = {i}")).unionAll(t.where(f"record_id % 2 = {i}")) for i in (1, 0))
    versions = {
        "order": (t, t.orderBy(F.desc("record_id"))),
        "value": (t, t.withColumn("trip_time", F.when(first, F.coalesce("trip_time", F.lit(0)) + 1).otherwise(F.col("trip_time")))),
        "repeated rows": (odd, even),
        "one row more": (t, t.unionAll(t.where(first))),
    }
    hashes = [hashing.content_hash(x.drop("record_id")).select(F.lit(name).alias("change"), "content_hash") for name, pair in versions.items() for x in pair]
    return reduce(DataFrame.unionAll, hashes).groupBy("change").agg((F.count_distinct("content_hash") == 1).alias("same"))


def time_buckets(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("pickup_datetime")
    return _trips(spark, d).select("record_id", *[bucket(ts, m).alias(f"b{m}") for m in (1, 7, 15, 60, 1440)])


def durations(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).select("record_id", seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("seconds"))


def drop_and_select(spark: SparkSession, d: str) -> DataFrame:
    return _trips(spark, d).drop("support_note", "missing").select("record_id", "PULocationID", "DOLocationID", "trip_miles")


def export_tlc(spark: SparkSession, d: str) -> DataFrame:
    """The row-level policy's release: pseudonyms, 15-minute times, redacted notes."""
    policy, _ = load_policy(POLICIES / "tlc_trip_submission.yaml")
    return E.export(_trips(spark, d), policy, SALT)


def export_tlc_fields(spark: SparkSession, d: str) -> DataFrame:
    """That release without its notes, whose masking SQL can't repeat."""
    return export_tlc(spark, d).drop("support_note")


def export_le(spark: SparkSession, d: str) -> DataFrame:
    policy, _ = load_policy(POLICIES / "law_enforcement_extract.yaml")
    return E.export(_trips(spark, d), policy, SALT)


def withheld_columns(spark: SparkSession, d: str) -> DataFrame:
    t = _trips(spark, d)
    return spark.createDataFrame([(c,) for c in E.withheld(t.columns, export_le(spark, d).columns)], "column string")


def policy_plans(spark: SparkSession, d: str) -> DataFrame:
    """The compiled steps of the shipped policies."""
    rows = [(p.stem, i, s.op) for p in sorted(POLICIES.glob("*.yaml")) for i, s in enumerate(compile_policy(load_policy(p)[0]))]
    return spark.createDataFrame(rows, "policy string, position int, op string")


def _dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, tier) for tier, columns in S.TIERS.items() for c in columns], "column string, tier string")


def classification_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _dictionary(spark).groupBy("tier").agg(F.count(F.lit(1)).alias("columns"))


def unclassified_columns(spark: SparkSession, d: str) -> DataFrame:
    return readers.schema_of(_trips(spark, d)).select("column").join(_dictionary(spark), "column", "left_anti")


_EMAIL = next(r for r in spans.RECOGNIZERS if r.entity_type == "EMAIL_ADDRESS")


def email_spans(spark: SparkSession, d: str) -> DataFrame:
    """Offsets of every e-mail address in the documents."""
    t = table(spark, d, "documents").select("doc_id", "text").where("text like '%@%'")
    return t.select("doc_id", F.explode(spans.matches(F.col("text"), _EMAIL)).alias("s")).select("doc_id", "s.start", "s.end")


def email_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.size(F.regexp_extract_all("text", F.lit(_EMAIL.pattern), F.lit(0))), F.lit(0)).alias("n")).where("n > 0")


def redacted_emails(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", "text")
    return t.select("doc_id", F.when(F.col("text").contains("@"), spans.redact(F.col("text"), spans.matches(F.col("text"), _EMAIL))).otherwise(F.col("text")).alias("text"))


def note_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans of all recognizers in the support notes, without overlaps."""
    notes = _trips(spark, d).where("support_note is not null").select("record_id", spans.scan(F.col("support_note")).alias("f"))
    return notes.select("record_id", F.explode("f").alias("s")).select("record_id", "s.*")


def redact_audit(spark: SparkSession, d: str) -> DataFrame:
    notes = _trips(spark, d).where("support_note is not null").select(F.size(spans.scan(F.col("support_note"))).alias("n"))
    return notes.agg(F.count_if(F.col("n") > 0).alias("rows_redacted"), F.coalesce(F.sum("n"), F.lit(0)).alias("spans_masked"))


def _scored_notes(spark: SparkSession, d: str) -> DataFrame:
    return synth.notes(_trips(spark, d), "record_id").withColumn("found", spans.scan(F.col("support_note")))


def detection_scores(spark: SparkSession, d: str) -> DataFrame:
    """Precision and recall of the recognizers on synthetic notes."""
    return evaluate.scores(evaluate.outcomes(_scored_notes(spark, d)))


def detection_targets(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.meets_targets(detection_scores(spark, d))


def heldout_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the recognizers on notes in formats they don't know."""
    return evaluate.scores(evaluate.outcomes(synth.heldout_notes(_trips(spark, d), "record_id").withColumn("found", spans.scan(F.col("support_note")))))


def dev_slice_labels(spark: SparkSession, d: str) -> DataFrame:
    """Gold labels of a slice of 5,000 sampled trips: the slice is the feature."""
    return synth.dev_slice(_trips(spark, d), "record_id", SAMPLE_COLUMNS, 5000)[1]


def synthetic_identities(spark: SparkSession, d: str) -> DataFrame:
    return synth.identities(_trips(spark, d).select("record_id"), "record_id")


def synthetic_checks(spark: SparkSession, d: str) -> DataFrame:
    """What synthetic identities keep: a trip id per row, well-formed values, pools of a fifth and an eighth of the rows at most."""
    uuid = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    forms = {"trip_id": uuid, "rider_id": uuid, "device_id": uuid, "rider_phone": r"^\d{3}-\d{3}-\d{4}$", "payment_token": "^[0-9a-f]{16}$", "vehicle_plate": r"^[A-Z]{3}-\d{4}$", "vehicle_vin": "^[A-HJ-NPR-Z0-9]{17}$", "driver_license_num": r"^\d{6,7}$"}
    rows = F.count(F.lit(1))
    return synthetic_identities(spark, d).agg(
        rows.alias("rows"), F.count_distinct("trip_id").alias("trip_ids"), *[F.count_if(~F.col(c).rlike(form) | F.col(c).isNull()).alias(f"bad_{c}") for c, form in forms.items()],
        (F.count_distinct("rider_id") * 5 <= rows).alias("riders_fit"), (F.count_distinct("vehicle_vin") * 8 <= rows).alias("drivers_fit"),
    )


def synthetic_notes(spark: SparkSession, d: str) -> DataFrame:
    return synth.notes(_trips(spark, d), "record_id")


def synth_stats(spark: SparkSession, d: str) -> DataFrame:
    """Rows, riders, notes, spans and decoys that were made."""
    return synth.stats(synthetic_identities(spark, d), synthetic_notes(spark, d))


def request_field_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Privacy tier of every requested field."""
    return table(spark, d, "triage_requests").select("request_id", F.posexplode("fields").alias("position", "field")).withColumn("tier", triage.field_tier(F.col("field")))


def request_profiles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "triage_requests").select("request_id", triage.request_profile(F.col("scope"), F.col("fields")).alias("profile"))


_RECORDS = [
    ("fetch", "2026-06-01T08:00:00+00:00", {"metrics": {"month": "2026-04", "row_count": 1000}}),
    ("validate", "2026-06-01T08:10:00+00:00", {"metrics": {"source": "month:2026-04", "health_score": 99.5, "refused": False}}),
    ("risk", "2026-06-01T08:20:00+00:00", {"source": "month:2026-04", "metrics": {"ladder": [{"qi": "zone", "uniqueness": 0.9}, {"qi": "borough", "uniqueness": 0.1}]}}),
    ("export", "2026-06-01T09:00:00+00:00", {"source": "month:2026-04", "policy_name": "mds_aggregate", "output_kind": "aggregate", "rows_in": 1000, "rows_out": 950, "cells_suppressed": 50, "k_achieved": 5, "refused": False, "gate": {"health_score": 99.5, "refused": False}}),
    ("triage", "2026-06-01T10:00:00+00:00", {"metrics": {"request_id": "r1", "verdict": "allow", "profile": "le", "pii_redacted_in_draft": 0}}),
    ("approve", "2026-06-01T11:00:00+00:00", {"metrics": {"request_id": "r1"}}),
    ("export", "2026-06-01T12:00:00+00:00", {"source": "dev", "policy_name": "law_enforcement_extract", "output_kind": "row_level", "rows_in": 100, "rows_out": 100, "cells_suppressed": 0, "refused": False, "approval_id": "r1", "gate": {"health_score": 98.0, "refused": False}}),
    ("triage", "2026-06-01T13:00:00+00:00", {"metrics": {"request_id": "r2", "verdict": "escalate", "profile": None, "pii_redacted_in_draft": 1}}),
    ("validate", "2026-06-02T08:10:00+00:00", {"metrics": {"source": "month:2026-04", "health_score": 97.25, "refused": False}}),
]


def ledger_lines(spark: SparkSession) -> DataFrame:
    """A sample ledger of nine entries."""
    last, lines = None, []
    for command, at, record in _RECORDS:
        last = ledger.make_entry(last, record, command, "sample", "run", at)
        lines.append((last["seq"], ledger.canonical(last)))
    return spark.createDataFrame(lines, "pos bigint, line string")


def ledger_verify(spark: SparkSession, d: str) -> DataFrame:
    return ledger.verify(ledger_lines(spark))


def ledger_tampered(spark: SparkSession, d: str) -> DataFrame:
    """The same ledger with a changed figure in its fourth entry."""
    return ledger.verify(ledger_lines(spark).withColumn("line", F.when(F.col("pos") == 3, F.replace("line", F.lit('"rows_out":950'), F.lit('"rows_out":951'))).otherwise(F.col("line"))))


def _entries(spark: SparkSession) -> DataFrame:
    return dashboard.entries(ledger_lines(spark))


def ledger_events(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.ledger_events(_entries(spark))


def exports_table(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.exports(_entries(spark), DEV_MONTH)


def validation_table(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.validation(_entries(spark), DEV_MONTH)


def uniqueness_table(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.uniqueness(_entries(spark), DEV_MONTH)


def suppression_table(spark: SparkSession, d: str) -> DataFrame:
    reports = spark.createDataFrame([("month:2026-04", [("zone", 5, 0.8, 200), ("borough", 5, 0.01, 990)])], "source string, suppression array<struct<qi:string,k:int,suppressed:double,rows_out:bigint>>")
    return dashboard.suppression(reports)


def triage_table(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.triage(_entries(spark))


def requests_table(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.requests(_entries(spark))


def health_trend(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.trend(validation_table(spark, d), "month", "health_score", "timestamp_utc")


QUERIES = {
    f.__name__: f
    for f in (
        uniqueness_ladder, ladder_figure, suppression_trend, detection_table, equivalence_classes, custom_qi_risk, class_size_histogram, k_suppressed_rows, class_size_per_row, mds_aggregate, mds_cells_summary, dimension_aggregate,
        zone_rollup_left, zone_rollup_inner, license_filter_count, trip_schema, sql_passthrough, sql_parameters, notes_by_trip, profile_one_pass, health_gate, health_gate_license, health_score, health_score_clean, suppression_audits, zone_day_counts, null_cells_by_column, money_profile, validity_rule_counts,
        consistency_rule_counts, contract_failures, duplicate_rows, uncastable_values, pseudonymized_ids, salt_disjointness, value_hashes, salt_fingerprint, uuid5_trip_ids, hash_sample, content_hash, content_hash_changes,
        time_buckets, durations, drop_and_select, export_tlc, export_tlc_fields, export_le, withheld_columns, policy_plans, classification_tiers, unclassified_columns, email_spans, email_counts, redacted_emails,
        note_spans, redact_audit, detection_scores, detection_targets, heldout_scores, dev_slice_labels, synthetic_identities, synthetic_checks, synthetic_notes, synth_stats, request_field_tiers, request_profiles, ledger_verify, ledger_tampered, ledger_events,
        exports_table, validation_table, uniqueness_table, suppression_table, triage_table, requests_table, health_trend,
    )
}
from quietfare.queries.reference_sql import ORACLES  # noqa: E402,F401
