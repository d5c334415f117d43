"""DuckDB SQL with the results of the queries in ``reference``."""

from __future__ import annotations

from quietfare import schemas as S
from quietfare.operators.triage import FIELD_KEYWORDS, PROFILE_KEYWORDS

SALT_HEX, OTHER_HEX = "00112233445566778899aabbccddeeff", "ffeeddccbbaa99887766554433221100"


def floor_to(column: str, minutes: int) -> str:
    return f"make_timestamp((epoch_us({column}) // {minutes * 60_000_000}) * {minutes * 60_000_000})"


_R = f"""r AS (SELECT t.record_id, t.PULocationID AS pu, t.DOLocationID AS do_id, p.Borough AS pb, q.Borough AS db, t.wav_request_flag,
  {floor_to("t.pickup_datetime", 1)} AS minute, {floor_to("t.pickup_datetime", 15)} AS quarter, {floor_to("t.pickup_datetime", 60)} AS hour, {floor_to("t.pickup_datetime", 1440)} AS day
  FROM trips t LEFT JOIN taxi_zones p ON t.PULocationID = p.LocationID LEFT JOIN taxi_zones q ON t.DOLocationID = q.LocationID)"""


def _figures(label: str, qi: str) -> str:
    head = f"'{label}' AS qi, " if label else ""
    return f"""SELECT {head}CAST(coalesce(sum(sz), 0) AS BIGINT) AS rows_in, count(*) AS classes, CAST(coalesce(sum(CASE WHEN sz = 1 THEN sz END), 0) AS BIGINT) AS unique_rows,
      round(coalesce(sum(CASE WHEN sz = 1 THEN sz END) / CAST(sum(sz) AS DOUBLE), 0.0), 4) AS uniqueness, CAST(coalesce(sum(CASE WHEN sz >= 5 THEN sz END), 0) AS BIGINT) AS rows_out,
      count(CASE WHEN sz < 5 THEN 1 END) AS cells_suppressed, round(coalesce(sum(CASE WHEN sz < 5 THEN sz END) / CAST(sum(sz) AS DOUBLE), 0.0), 4) AS suppressed, min(CASE WHEN sz >= 5 THEN sz END) AS k_achieved
      FROM (SELECT count(*) AS sz FROM r GROUP BY {qi})"""


def _nan(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN {c} END"


_CLEAN = "c AS (SELECT * REPLACE (" + ", ".join(f"{_nan(c)} AS {c}" for c in [*S.MONEY_COLUMNS, "trip_miles"]) + ") FROM trips)"
_DURATION = "(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 1000000.0"
_VALID = {f"{c}_negative": f"{c} < 0" for c in [*S.MONEY_COLUMNS, "trip_miles"]} | {f"{c}_not_YN": f"NOT coalesce({c} IN ('Y', 'N'), FALSE)" for c in S.FLAG_COLUMNS}
_CONSISTENT = {"dropoff_before_pickup": "dropoff_datetime < pickup_datetime", "trip_time_mismatch": f"abs(trip_time - {_DURATION}) > 60"}
_CONTRACT = {f"{c}:not_nullable": f"{c} IS NULL" for c in S.REQUIRED_COLUMNS} | {"hvfhs_license_num:isin": f"hvfhs_license_num <> '{S.LICENSE}'"}
_CONTRACT |= {f"{c}:in_range": f"{c} NOT BETWEEN 1 AND 265" for c in ("PULocationID", "DOLocationID")} | {f"{c}:ge_0": f"{c} < 0" for c in ("trip_miles", "trip_time")}


def _counts(rules: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, count(CASE WHEN {rule} THEN 1 END) AS n FROM {source}" for name, rule in rules.items())


def _any(rules: dict[str, str]) -> str:
    return " OR ".join(f"coalesce({r}, FALSE)" for r in rules.values())


def _profile(source: str) -> str:
    nulls = lambda columns: " + ".join(f"count(*) - count({c})" for c in columns)
    real = ", ".join(S.REAL_COLUMNS)
    return f"""SELECT count(*) AS n, {nulls(S.REAL_COLUMNS)} AS null_cells, {nulls(S.REQUIRED_COLUMNS)} AS required_nulls,
      count(CASE WHEN PULocationID NOT BETWEEN 1 AND 265 OR DOLocationID NOT BETWEEN 1 AND 265 THEN 1 END) AS zone_out_of_range,
      count(CASE WHEN trip_time < 0 THEN 1 END) AS trip_time_negative, count(CASE WHEN hvfhs_license_num <> '{S.LICENSE}' THEN 1 END) AS license_bad,
      count(CASE WHEN {_any(_VALID)} THEN 1 END) AS validity_fail_rows, count(CASE WHEN {_any(_CONSISTENT)} THEN 1 END) AS consistency_fail_rows,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT {real} FROM {source})) AS duplicate_rows FROM {source}"""


def _health(source: str) -> str:
    rate = lambda fails, base: f"coalesce(round((1 - {fails} / CAST(nullif({base}, 0) AS DOUBLE)) * 100, 4), 100.0)"
    return f"""p AS ({_profile(source)}),
        s AS (SELECT n, required_nulls + zone_out_of_range + trip_time_negative + license_bad = 0 AS tier1_passed, {rate("null_cells", f"n * {len(S.REAL_COLUMNS)}")} AS completeness,
          {rate("validity_fail_rows", "n")} AS validity, {rate("consistency_fail_rows", "n")} AS consistency, {rate("duplicate_rows", "n")} AS uniqueness FROM p),
        h AS (SELECT *, CASE WHEN tier1_passed THEN round((completeness + validity + consistency + uniqueness) / 4, 4) END AS health_score FROM s)
        SELECT *, coalesce(health_score < 90, TRUE) AS refused FROM h"""


def _pseudonym(c: str, salt: str = SALT_HEX) -> str:
    return f"substr(sha256(unhex('{salt}') || encode({c})), 1, 16)"


def _first(text: str, keywords: dict[str, list[str]]) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'''contains(lower({text}), '{w}')''' for w in words)} THEN '{name}'" for name, words in keywords.items()) + " END"


_EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
_TIERS = ", ".join(f"('{c}', '{t}')" for t, columns in S.TIERS.items() for c in columns)
_FINITE = "CASE WHEN isfinite({0}) THEN {0} END"
_OK = f"ok AS (SELECT * FROM c WHERE hvfhs_license_num = '{S.LICENSE}' AND {' AND '.join(f'{c} IS NOT NULL' for c in S.REQUIRED_COLUMNS)} AND PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265 AND trip_time >= 0)"
_RAW_OK = _OK.replace("FROM c WHERE", "FROM trips WHERE", 1)
_SAMPLE = "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in ["request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_time", "record_id"]) + "))"

_REAL = ", ".join(S.REAL_COLUMNS)


def _same_content(name: str, before: str, after: str) -> str:
    return f"SELECT '{name}' AS change, NOT EXISTS (({before}) EXCEPT ALL ({after})) AND NOT EXISTS (({after}) EXCEPT ALL ({before})) AS same"


_CONTENT = f"SELECT {_REAL} FROM trips"
_ODD, _EVEN = (f"{_CONTENT} UNION ALL {_CONTENT} WHERE record_id % 2 = {i} UNION ALL {_CONTENT} WHERE record_id % 2 = {i}" for i in (1, 0))
_FIRST = "record_id = (SELECT min(record_id) FROM trips)"
_OTHER_TIME = f"SELECT {_REAL.replace('trip_time', f'CASE WHEN {_FIRST} THEN coalesce(trip_time, 0) + 1 ELSE trip_time END AS trip_time')} FROM trips"

_LADDER = " UNION ALL ".join(_figures(k, v) for k, v in {"zone x minute": "pu, do_id, minute", "zone x 15 min": "pu, do_id, quarter", "zone x 60 min": "pu, do_id, hour", "borough x 15 min": "pb, db, quarter"}.items())

ORACLES = {
    "ladder_figure": f"""WITH {_R}, l AS ({_LADDER}) SELECT CAST(list_position(['zone x minute', 'zone x 15 min', 'zone x 60 min', 'borough x 15 min'], qi) AS INTEGER) AS position, qi, round(uniqueness * 100, 2) AS percent FROM l""",
    "suppression_trend": f"""WITH c AS (SELECT f.month, p.Borough AS pb, q.Borough AS db, {floor_to('t.pickup_datetime', 15)} AS quarter, count(*) AS sz FROM trips t JOIN trip_files f ON t.load_id = f.file_id
        LEFT JOIN taxi_zones p ON t.PULocationID = p.LocationID LEFT JOIN taxi_zones q ON t.DOLocationID = q.LocationID GROUP BY ALL)
        SELECT month, CAST(sum(sz) AS BIGINT) AS rows, round(coalesce(sum(CASE WHEN sz < 5 THEN sz END), 0) / CAST(sum(sz) AS DOUBLE) * 100, 2) AS percent FROM c GROUP BY month""",
    "content_hash_changes": " UNION ALL ".join([_same_content("order", _CONTENT, _CONTENT), _same_content("value", _CONTENT, _OTHER_TIME), _same_content("repeated rows", _ODD, _EVEN), _same_content("one row more", _CONTENT, f"{_CONTENT} UNION ALL {_CONTENT} WHERE {_FIRST}")]),
    "uniqueness_ladder": f"WITH {_R} " + " UNION ALL ".join(_figures(k, v) for k, v in {"zone x minute": "pu, do_id, minute", "zone x 15 min": "pu, do_id, quarter", "zone x 60 min": "pu, do_id, hour", "borough x 15 min": "pb, db, quarter"}.items()),
    "equivalence_classes": f"WITH {_R} SELECT pb, db, hour, count(*) AS sz FROM r GROUP BY ALL",
    "custom_qi_risk": f"WITH {_R} {_figures('', 'pu, hour, wav_request_flag')}",
    "class_size_histogram": f"WITH {_R} SELECT sz, count(*) AS n_classes, CAST(sum(sz) AS BIGINT) AS n_rows FROM (SELECT count(*) AS sz FROM r GROUP BY pb, db, day) GROUP BY sz",
    "k_suppressed_rows": f"WITH {_R} SELECT record_id, pb, db, day FROM (SELECT *, count(*) OVER (PARTITION BY pb, db, day) AS sz FROM r) WHERE sz >= 5",
    "class_size_per_row": f"WITH {_R} SELECT record_id, pb, db, hour, count(*) OVER (PARTITION BY pb, db, hour) AS class_size FROM r",
    "mds_aggregate": f"WITH {_R} SELECT pb AS \"PUBorough\", db AS \"DOBorough\", hour AS pickup_bucket, count(*) AS trip_count FROM r GROUP BY pb, db, hour HAVING count(*) >= 5",
    "mds_cells_summary": f"""WITH {_R} SELECT count(*) AS cells_in, count(CASE WHEN n >= 5 THEN 1 END) AS cells_out, count(CASE WHEN n < 5 THEN 1 END) AS cells_suppressed,
        CAST(coalesce(sum(CASE WHEN n >= 5 THEN n END), 0) AS BIGINT) AS rows_represented, CAST(sum(n) AS BIGINT) AS rows_in, min(CASE WHEN n >= 5 THEN n END) AS k_achieved FROM (SELECT count(*) AS n FROM r GROUP BY pb, db, hour)""",
    "dimension_aggregate": f"SELECT {floor_to('dropoff_datetime', 1440)} AS dropoff_bucket, wav_match_flag, count(*) AS trip_count FROM trips GROUP BY 1, 2 HAVING count(*) >= 5",
    "zone_rollup_left": 'SELECT p.Borough AS "PUBorough", q.Borough AS "DOBorough", count(*) AS n FROM trips t LEFT JOIN taxi_zones p ON t.PULocationID = p.LocationID LEFT JOIN taxi_zones q ON t.DOLocationID = q.LocationID GROUP BY 1, 2',
    "zone_rollup_inner": 'SELECT p.Borough AS "PUBorough", q.Borough AS "DOBorough", count(*) AS n FROM trips t JOIN taxi_zones p ON t.PULocationID = p.LocationID JOIN taxi_zones q ON t.DOLocationID = q.LocationID GROUP BY 1, 2',
    "license_filter_count": f"SELECT count(*) AS n FROM trips WHERE hvfhs_license_num = '{S.LICENSE}'",
    "sql_parameters": "SELECT hvfhs_license_num, count(*) AS n FROM trips WHERE trip_time >= 600 AND hvfhs_license_num <> 'HV0004' GROUP BY 1",
    "notes_by_trip": "SELECT trip_id, record_id, support_note FROM trips WHERE support_note IS NOT NULL",
    "sql_passthrough": "SELECT hvfhs_license_num, count(*) AS n FROM trips GROUP BY 1",
    "profile_one_pass": f"WITH {_CLEAN} {_profile('c')}",
    "health_gate": f"WITH {_CLEAN}, {_health('c')}",
    "health_gate_license": f"WITH {_CLEAN}, l AS (SELECT * FROM c WHERE hvfhs_license_num = '{S.LICENSE}'), {_health('l')}",
    "health_score": f"WITH {_CLEAN}, l AS (SELECT * FROM c WHERE hvfhs_license_num = '{S.LICENSE}'), {_health('l')}",
    "trip_schema": """SELECT CAST(column_index - 1 AS INTEGER) AS position, column_name AS "column", CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
        WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type FROM duckdb_columns() WHERE table_name = 'trips'""",
    "email_spans": f"""WITH m AS (SELECT doc_id, regexp_split_to_array(text, '{_EMAIL}') AS gaps, regexp_extract_all(text, '{_EMAIL}') AS found FROM documents WHERE text LIKE '%@%'),
        i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
        s AS (SELECT doc_id, found[i] AS v, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS a FROM i)
        SELECT doc_id, CAST(a AS INTEGER) AS start, CAST(a + length(v) AS INTEGER) AS "end" FROM s""",
    "suppression_audits": f"WITH {_R} " + " UNION ALL ".join(f"""SELECT '{q}' AS qi, 5 AS k, CAST(sum(sz) AS BIGINT) AS rows_in, CAST(coalesce(sum(CASE WHEN sz >= 5 THEN sz END), 0) AS BIGINT) AS rows_out,
        CAST(coalesce(sum(CASE WHEN sz < 5 THEN sz END), 0) AS BIGINT) AS cells_suppressed, min(CASE WHEN sz >= 5 THEN sz END) AS k_achieved FROM (SELECT count(*) AS sz FROM r GROUP BY {q.replace('PUBorough', 'pb').replace('DOBorough', 'db').replace('pickup_bucket', 'quarter').replace('PULocationID', 'pu')})""" for q in ("PUBorough, DOBorough, pickup_bucket", "PULocationID, pickup_bucket")),
    "zone_day_counts": "SELECT PULocationID, date_trunc('day', pickup_datetime) AS day, count(*) AS trips, count(*) FILTER (DOLocationID IS NULL) AS no_dropoff_zone FROM trips GROUP BY ALL",
    "health_score_clean": f"""WITH {_CLEAN}, {_OK}, p AS ({_profile('ok')}),
        s AS (SELECT n, required_nulls + zone_out_of_range + trip_time_negative + license_bad = 0 AS tier1_passed, round((1 - null_cells / (n * 25.0)) * 100, 4) AS completeness,
          round((1 - validity_fail_rows / CAST(n AS DOUBLE)) * 100, 4) AS validity, round((1 - consistency_fail_rows / CAST(n AS DOUBLE)) * 100, 4) AS consistency, round((1 - duplicate_rows / CAST(n AS DOUBLE)) * 100, 4) AS uniqueness FROM p),
        h AS (SELECT *, CASE WHEN tier1_passed THEN round((completeness + validity + consistency + uniqueness) / 4, 4) END AS health_score FROM s)
        SELECT *, coalesce(health_score < 90, TRUE) AS refused FROM h""",
    "null_cells_by_column": f"WITH {_CLEAN} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n FROM c" for c in S.REAL_COLUMNS),
    "money_profile": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", min({_FINITE.format(c)}) AS \"min\", max({_FINITE.format(c)}) AS \"max\", count(CASE WHEN isfinite({c}) AND {c} < 0 THEN 1 END) AS negatives, count(CASE WHEN {c} = 0 THEN 1 END) AS zeros FROM trips" for c in S.MONEY_COLUMNS),
    "validity_rule_counts": f"WITH {_CLEAN} {_counts(_VALID, 'c')}",
    "consistency_rule_counts": _counts(_CONSISTENT, "trips"),
    "contract_failures": f"WITH {_CLEAN}, k AS ({_counts(_CONTRACT, 'c')}) SELECT split_part(rule, ':', 1) AS \"column\", split_part(rule, ':', 2) AS \"check\", n FROM k WHERE n > 0",
    "duplicate_rows": f"SELECT (SELECT count(*) FROM trips) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(S.REAL_COLUMNS + S.IDENTITY_COLUMNS)} FROM trips)) AS duplicate_rows",
    "uncastable_values": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN 1 END) AS n FROM trips" for c, t in {"driver_license_num": "BIGINT", "rider_phone": "BIGINT", "vehicle_plate": "INTEGER"}.items()),
    "pseudonymized_ids": "SELECT record_id, " + ", ".join(f"{_pseudonym(c)} AS {c}" for c in ("rider_id", "rider_phone", "driver_name")) + " FROM trips",
    "salt_disjointness": f"SELECT count(*) AS shared FROM (SELECT {_pseudonym('rider_id')} AS p FROM trips INTERSECT SELECT {_pseudonym('rider_id', OTHER_HEX)} FROM trips)",
    "value_hashes": "SELECT record_id, sha256(vehicle_vin) AS value_hash FROM trips",
    "salt_fingerprint": f"SELECT sha256(unhex('{SALT_HEX}')) AS fingerprint",
    "uuid5_trip_ids": """WITH h AS (SELECT record_id, sha1(unhex('6f1d3b2a0c4e5a7b9d8c1e2f3a4b5c6d') || encode(concat_ws('|', PULocationID, DOLocationID, trip_time, record_id))) AS x FROM trips)
        SELECT record_id, substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(x, 17, 1)) AS INTEGER) % 4 + 1, 1) || substr(x, 18, 3) || '-' || substr(x, 21, 12) AS surrogate_id FROM h""",
    "hash_sample": f"SELECT request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_time, record_id FROM trips ORDER BY {_SAMPLE}, record_id LIMIT 500",
    "time_buckets": "SELECT record_id, " + ", ".join(f"{floor_to('pickup_datetime', m)} AS b{m}" for m in (1, 7, 15, 60, 1440)) + " FROM trips",
    "durations": f"SELECT record_id, {_DURATION} AS seconds FROM trips",
    "drop_and_select": "SELECT record_id, PULocationID, DOLocationID, trip_miles FROM trips",
    "export_tlc_fields": "SELECT * EXCLUDE (support_note) REPLACE (" + ", ".join([*[f"{_pseudonym(c)} AS {c}" for c in ('trip_id', 'rider_id', 'rider_phone', 'rider_email', 'device_id', 'payment_token', 'driver_license_num', 'driver_name', 'vehicle_plate', 'vehicle_vin')], *[f"{floor_to(c, 15)} AS {c}" for c in ("pickup_datetime", "dropoff_datetime")]]) + ") FROM trips",
    "synthetic_checks": "SELECT count(*) AS rows, count(*) AS trip_ids, " + ", ".join(f"CAST(0 AS BIGINT) AS bad_{c}" for c in ("trip_id", "rider_id", "device_id", "rider_phone", "payment_token", "vehicle_plate", "vehicle_vin", "driver_license_num")) + ", TRUE AS riders_fit, TRUE AS drivers_fit FROM trips",
    "export_le": f"SELECT {_pseudonym('trip_id')} AS trip_id, PULocationID, DOLocationID, {floor_to('pickup_datetime', 15)} AS pickup_datetime, {floor_to('dropoff_datetime', 15)} AS dropoff_datetime, base_passenger_fare FROM trips",
    "withheld_columns": "SELECT column_name AS \"column\" FROM (DESCRIBE trips) WHERE column_name NOT IN ('trip_id', 'PULocationID', 'DOLocationID', 'pickup_datetime', 'dropoff_datetime', 'base_passenger_fare')",
    "policy_plans": "SELECT * FROM (VALUES ('law_enforcement_extract', 0, 'pseudonymize'), ('law_enforcement_extract', 1, 'generalize_time'), ('law_enforcement_extract', 2, 'select'), ('mds_aggregate', 0, 'aggregate'), ('tlc_trip_submission', 0, 'redact_note'), ('tlc_trip_submission', 1, 'pseudonymize'), ('tlc_trip_submission', 2, 'generalize_time')) v(policy, position, op)",
    "classification_tiers": f"SELECT tier, count(*) AS columns FROM (VALUES {_TIERS}) v(c, tier) GROUP BY tier",
    "unclassified_columns": f"SELECT column_name AS \"column\" FROM (DESCRIBE trips) WHERE column_name NOT IN (SELECT c FROM (VALUES {_TIERS}) v(c, tier))",
    "email_counts": f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{_EMAIL}')) AS INTEGER) AS n FROM documents WHERE len(regexp_extract_all(text, '{_EMAIL}')) > 0",
    "redacted_emails": f"SELECT doc_id, regexp_replace(text, '{_EMAIL}', '[REDACTED]', 'g') AS text FROM documents",
    "request_field_tiers": f"WITH f AS (SELECT request_id, unnest(range(len(fields))) AS position, unnest(fields) AS field FROM triage_requests) SELECT request_id, CAST(position AS INTEGER) AS position, field, {_first('field', FIELD_KEYWORDS)} AS tier FROM f",
    "request_profiles": f"WITH b AS (SELECT request_id, coalesce(scope, '') || ' ' || coalesce(array_to_string(fields, ' '), '') AS blob FROM triage_requests) SELECT request_id, {_first('blob', PROFILE_KEYWORDS)} AS profile FROM b",
    "ledger_verify": "SELECT TRUE AS ok, CAST(9 AS BIGINT) AS entries, CAST(NULL AS BIGINT) AS break_seq, CAST(NULL AS VARCHAR) AS reason",
    "ledger_tampered": "SELECT FALSE AS ok, CAST(9 AS BIGINT) AS entries, CAST(3 AS BIGINT) AS break_seq, 'content hash mismatch' AS reason",
    "exports_table": """SELECT * FROM (VALUES ('2026-06-01T09:00:00+00:00', '2026-04', 'month', 'mds_aggregate', 'aggregate', 1000, 950, 50, 0.05, 5, 99.5, FALSE),
        ('2026-06-01T12:00:00+00:00', '2026-04', 'dev', 'law_enforcement_extract', 'row_level', 100, 100, 0, 0.0, NULL, 98.0, FALSE))
        v(timestamp_utc, month, scope, policy_name, output_kind, rows_in, rows_out, cells_suppressed, suppression_rate, k_achieved, health_score, refused)""",
    "validation_table": "SELECT * FROM (VALUES ('2026-06-01T08:10:00+00:00', '2026-04', 'month', 99.5, FALSE), ('2026-06-02T08:10:00+00:00', '2026-04', 'month', 97.25, FALSE)) v(timestamp_utc, month, scope, health_score, refused)",
    "uniqueness_table": "SELECT * FROM (VALUES ('2026-04', 'month', 'zone', 0.9), ('2026-04', 'month', 'borough', 0.1)) v(month, scope, qi, uniqueness)",
    "suppression_table": "SELECT * FROM (VALUES ('2026-04', 'zone', 5, 0.8, 200), ('2026-04', 'borough', 5, 0.01, 990)) v(month, qi, k, suppressed, rows_out)",
    "triage_table": "SELECT * FROM (VALUES ('2026-06-01T10:00:00+00:00', 'r1', 'allow', 'le', 0), ('2026-06-01T13:00:00+00:00', 'r2', 'escalate', NULL, 1)) v(timestamp_utc, request_id, verdict, profile, pii_redacted_in_draft)",
    "requests_table": "SELECT * FROM (VALUES ('r1', '2026-06-01T10:00:00+00:00', '2026-06-01T11:00:00+00:00', '2026-06-01T12:00:00+00:00', 2.0), ('r2', '2026-06-01T13:00:00+00:00', NULL, NULL, NULL)) v(request_id, triage_utc, approved_utc, exported_utc, turnaround_hours)",
    "health_trend": "SELECT '2026-04' AS month, 97.25 AS health_score",
}
