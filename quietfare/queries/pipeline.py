"""Queries of the general training-data operators: schema drift (2), heavy keys (3), column quality (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietfare.operators import drift, quality, skew
from quietfare.queries.common import table
from quietfare.session import cut

ZONES = ["PULocationID", "DOLocationID"]


def _trips(spark: SparkSession, d: str) -> DataFrame:
    """Trips with fares in cents and miles in thousandths, so that sums are exact in any order."""
    whole = lambda c, unit: F.round(skew.finite(F.col(c)) * unit)
    return table(spark, d, "trips").withColumns({"fare_cents": whole("base_passenger_fare", 100), "mile_thousandths": whole("trip_miles", 1000)})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Changes of the two fees from one file of a feed to the next."""
    return drift.drift_report(table(spark, d, "trip_file_rows"), table(spark, d, "trip_files")).select("file_id", "field", "change")


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    """Every raw record in one schema, both fees as numbers, the rest rescued as JSON."""
    return drift.promote(drift.ingest(table(spark, d, "trip_file_rows"), as_json=False))


def p2_changes(spark: SparkSession, d: str) -> DataFrame:
    """Changes of every field, typed or rescued, from one file of a feed to the next, with the keys or types before and after."""
    return drift.drift_report(table(spark, d, "trip_file_rows"), table(spark, d, "trip_files"), every_key=True)


def p2_typed(spark: SparkSession, d: str) -> DataFrame:
    """The table without its rescued JSON: only what reached a typed column."""
    return p2_table(spark, d).drop("rescued")


def p2_fee_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per file: records, readable records, numeric fees found and their sums."""
    return p2_table(spark, d).groupBy("file_id").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("readable").alias("readable_records"),
        F.count("airport_fee").alias("airport_fees"), F.count("cbd_congestion_fee").alias("cbd_fees"),
        F.round(F.coalesce(F.sum("airport_fee"), F.lit(0.0)), 2).alias("airport_sum"), F.round(F.coalesce(F.sum("cbd_congestion_fee"), F.lit(0.0)), 2).alias("cbd_sum"),
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Zones with at least 3 % of all rows, from the joined states of trips and zones."""
    return skew.heavy_keys(table(spark, d, "trips"), ZONES, table(spark, d, "taxi_zones").select("LocationID")).select("field", F.col("key").alias("zone_id"))


def p3_zone_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts and sums per pick-up and drop-off zone, with the zone's borough (null if unknown)."""
    sums = ["fare_cents", "mile_thousandths", "trip_time"]
    trips = skew.unpivot_keys(_trips(spark, d), ZONES, sums).withColumnRenamed("key", "zone_id")
    zones = table(spark, d, "taxi_zones").select(F.col("LocationID").alias("zone_id"), F.col("Borough").alias("borough"))
    out = skew.eager_join_aggregate(trips, zones, ["zone_id"], left_sums=sums, left_by=["field"], right_by=["borough"], how="left")
    return out.select("field", "zone_id", "borough", "rows", *[f"sum_{c}" for c in sums])


def p3_borough_flows(spark: SparkSession, d: str) -> DataFrame:
    """Trips, fares and miles between boroughs: pre-aggregated per zone pair, joined twice, rolled up."""
    sums = ["fare_cents", "mile_thousandths"]
    zones = table(spark, d, "taxi_zones")
    pick = zones.select(F.col("LocationID").alias("PULocationID"), F.col("Borough").alias("pu_borough"))
    drop = zones.select(F.col("LocationID").alias("DOLocationID"), F.col("Borough").alias("do_borough"))
    first = skew.eager_join_aggregate(_trips(spark, d), pick, ["PULocationID"], left_sums=sums, left_by=["DOLocationID"], right_by=["pu_borough"])
    pairs = skew.merge_key_states(first, ["DOLocationID", "pu_borough"]).join(drop, "DOLocationID")
    out = skew.merge_key_states(pairs, ["pu_borough", "do_borough"])
    return out.select("pu_borough", "do_borough", "rows", *[f"sum_{c}" for c in sums])


def p3_chained_trips(spark: SparkSession, d: str) -> DataFrame:
    """Per zone: pairs of a trip that ends there and a trip that starts there, and the sum of the first's time over them."""
    trips = table(spark, d, "trips")
    ends = trips.select(F.col("DOLocationID").alias("zone_id"), "trip_time")
    starts = trips.select(F.col("PULocationID").alias("zone_id"))
    out = skew.eager_join_aggregate(ends, starts, ["zone_id"], left_sums=["trip_time"])
    return out.select("zone_id", F.col("rows").alias("pairs"), F.col("sum_trip_time"))


def p3_trip_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Each trip's rank in its pick-up zone and in its drop-off zone, by pick-up time."""
    rows = skew.unpivot_keys(table(spark, d, "trips"), ZONES, ["pickup_datetime", "record_id"]).withColumnRenamed("key", "zone_id")
    return skew.rank_in_key(rows, ["field", "zone_id"], ["pickup_datetime", "record_id"], ["record_id"], "zone_rank")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Loads whose null rate, distinct count, range, pattern or distribution differs from the rest."""
    return quality.load_findings(p5_load_figures(spark, d, None), "load_id")


def p5_found_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same findings where the earlier loads' states were written before and only the later loads' rows are profiled."""
    trips = table(spark, d, "trips")
    earlier = F.coalesce(F.col("load_id") <= trips.agg(F.percentile_approx("load_id", 0.5)).scalar(), F.lit(True))
    history = cut(quality.value_states(trips.where(earlier), "load_id"))
    states = quality.merge_value_states(history.unionByName(quality.value_states(trips.where(~earlier), "load_id")), ["load_id"])
    return quality.load_findings(quality.load_figures(states, "load_id"), "load_id")


def p5_load_figures(spark: SparkSession, d: str, places: int | None = 6) -> DataFrame:
    """The figures of the four checked columns per load."""
    figures = quality.load_figures(quality.value_states(table(spark, d, "trips"), "load_id"), "load_id")
    if places is None:
        return figures
    return figures.withColumns({c: F.round(c, places) for c in ("null_rate", "bad_share", "good_median", "share")})


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of every column of trips per load."""
    return quality.read_profile(quality.profile_states(table(spark, d, "trips"), ["load_id"]))


def p5_profile_exact(spark: SparkSession, d: str) -> DataFrame:
    """The figures of the profile that are no estimates."""
    return p5_profile(spark, d).select("load_id", "column_name", "rows", "nulls", "nans", "malformed", "min_num", "max_num", "min_txt", "max_txt")


def p5_profile_all(spark: SparkSession, d: str) -> DataFrame:
    """Profile of every column over all loads, merged from the loads' states."""
    loads = table(spark, d, "trips").withColumn("_load", F.col("load_id"))
    return quality.read_profile(quality.merge_profile_states(quality.profile_states(loads, ["_load"])))


def p5_found_all(spark: SparkSession, d: str) -> DataFrame:
    """Loads whose profile of any column differs from the rest, from the states of :func:`p5_profile`."""
    trips = table(spark, d, "trips")
    serial = [*quality.SERIAL, *[c for c, kind in trips.dtypes if kind.startswith("timestamp")]]
    return quality.profile_findings(quality.profile_states(trips, ["load_id"]), "load_id", serial)


QUERIES = {f.__name__: f for f in (p2_found, p2_changes, p2_table, p2_typed, p2_fee_totals, p3_found, p3_zone_stats, p3_borough_flows, p3_chained_trips, p3_trip_ranks, p5_found, p5_found_incremental, p5_load_figures, p5_profile, p5_profile_exact, p5_profile_all, p5_found_all)}

_FIN = "CASE WHEN isfinite({0}) THEN {0} END"
_BOTH = "SELECT 'PULocationID' AS field, PULocationID AS zone_id, * FROM trips UNION ALL SELECT 'DOLocationID', DOLocationID, * FROM trips"
_FIGURES = """
WITH v AS (
  SELECT load_id, 'base_passenger_fare' AS column_name, base_passenger_fare AS num, CAST(NULL AS VARCHAR) AS txt FROM trips
  UNION ALL SELECT load_id, 'trip_miles', trip_miles, NULL FROM trips
  UNION ALL SELECT load_id, 'airport_fee', airport_fee, NULL FROM trips
  UNION ALL SELECT load_id, 'wav_request_flag', NULL, wav_request_flag FROM trips),
m AS (SELECT *, num IS NOT NULL AND isfinite(num) AND num >= 0 AS good,
  CASE WHEN column_name = 'wav_request_flag' THEN txt IS NOT NULL AND txt NOT IN ('Y', 'N')
       ELSE num IS NOT NULL AND NOT (isfinite(num) AND num >= 0 AND num <= 1000) END AS bad FROM v),
f AS (SELECT load_id, column_name, count(*) AS rows, count(*) - count(num) - count(txt) AS nulls,
  (count(*) - count(num) - count(txt)) / CAST(count(*) AS DOUBLE) AS null_rate,
  count(DISTINCT num) + count(DISTINCT txt) AS distinct_values,
  CASE WHEN count(num) + count(txt) > 0 THEN sum(CASE WHEN bad THEN 1.0 ELSE 0.0 END) / (count(num) + count(txt)) END AS bad_share,
  quantile_cont(CASE WHEN good THEN num END, 0.5) AS good_median,
  CASE WHEN column_name = 'wav_request_flag' THEN CASE WHEN count(txt) > 0 THEN sum(CASE WHEN txt = 'Y' THEN 1.0 ELSE 0.0 END) / count(txt) END
       WHEN sum(CASE WHEN good THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN good AND num > 0 THEN 1.0 ELSE 0.0 END) / sum(CASE WHEN good THEN 1 ELSE 0 END) END AS share
  FROM m GROUP BY load_id, column_name)
"""

_FEES = r"""
WITH r AS (SELECT file_id, row_id, payload, json_valid(payload) AS readable FROM trip_file_rows),
l1 AS (SELECT r.file_id, r.row_id, e.key AS k, e.type AS ty, e.value AS v FROM r, json_each(CASE WHEN r.readable THEN r.payload ELSE '{}' END) e),
l2 AS (SELECT file_id, row_id, k AS path, ty, v FROM l1 WHERE ty <> 'OBJECT'
  UNION ALL SELECT l1.file_id, l1.row_id, l1.k || '.' || e.key, e.type, e.value FROM l1, json_each(CASE WHEN l1.ty = 'OBJECT' THEN l1.v ELSE '{}' END) e WHERE l1.ty = 'OBJECT'),
w AS (SELECT *, '_' || regexp_replace(lower(regexp_replace(path, '([a-z0-9])([A-Z])', '\1_\2', 'g')), '[^a-z0-9]+', '_', 'g') || '_' AS x0 FROM l2),
x AS (SELECT *, regexp_replace(x0, '_+', '_', 'g') AS words FROM w),
f AS (SELECT file_id, row_id, path, ty, v,
    CASE WHEN regexp_matches(words, '_(airport|apt|arpt)_') AND regexp_matches(words, '_(fee|fees|charge|charges|surcharge|surcharges|amount|amt|usd|toll|tax)_') THEN 'airport_fee'
         WHEN regexp_matches(words, '_cbd_|_central_(business_)?district_') AND regexp_matches(words, '_(fee|fees|charge|charges|surcharge|surcharges|amount|amt|usd|toll|tax|relief|congestion)_') THEN 'cbd_congestion_fee' END AS field,
    CASE WHEN ty IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' WHEN ty = 'VARCHAR' THEN 'string' WHEN ty = 'BOOLEAN' THEN 'boolean' END AS kind FROM x)
"""



def _typed(column: str, kind: str) -> str:
    """A top-level value of a payload in its column's type, null unless the JSON type fits without loss."""
    value, ty = f"(payload->>'$.\"{column}\"')", f"json_type(payload, '$.\"{column}\"')"
    if kind == "double":
        return f"CASE WHEN readable AND {ty} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST({value} AS DOUBLE) END AS \"{column}\""
    if kind in ("int", "bigint"):
        return f"CASE WHEN readable AND {ty} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(CAST({value} AS DOUBLE) AS {kind}) = CAST({value} AS DOUBLE) THEN TRY_CAST(CAST({value} AS DOUBLE) AS {kind}) END AS \"{column}\""
    return f"CASE WHEN readable AND {ty} = 'VARCHAR' THEN TRY_CAST({value} AS {'TIMESTAMP' if kind == 'timestamp_ntz' else 'VARCHAR'}) END AS \"{column}\""


#: Continues ``_FEES`` with the amount of each record and fee.
_AMOUNTS = r""",
        v AS (SELECT row_id, field, path, CASE WHEN kind = 'number' THEN CAST(v AS DOUBLE)
            WHEN kind = 'string' THEN TRY_CAST(replace(trim(regexp_replace(trim(lower(v->>'$')), '^(usd|us\$|\$|€|eur)|(usd|us\$|\$|€|eur)$', '', 'g')), ',', '.') AS DOUBLE) END AS amount FROM f WHERE field IS NOT NULL),
        o AS (SELECT row_id, field, arg_min(amount, path) AS amount FROM v WHERE amount IS NOT NULL GROUP BY ALL)"""

_NUMBERS = ["trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay", "cbd_congestion_fee"]
_WHOLE = ["record_id", "PULocationID", "DOLocationID", "trip_time"]
_TIMES = ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime"]
_TEXTS = ["hvfhs_license_num", "dispatching_base_num", "originating_base_num", "shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag", "trip_id", "rider_id", "rider_phone", "rider_email", "device_id", "payment_token", "driver_license_num", "driver_name", "vehicle_plate", "vehicle_vin", "support_note"]


def _column_profile(c: str) -> str:
    number = f"(epoch_us({c}) / 1000000.0)" if c in _TIMES else f"CAST({c} AS DOUBLE)" if c not in _TEXTS else "CAST(NULL AS DOUBLE)"
    fit = f"CASE WHEN isfinite({number}) THEN {number} END"
    text = c if c in _TEXTS else "CAST(NULL AS VARCHAR)"
    wrong = f"NOT isfinite({number}) OR {number} < 0" if c in _NUMBERS else f"{number} < 0" if c in _WHOLE else f"NOT regexp_matches({c}, '{quality.PATTERNS[c]}')" if c in quality.PATTERNS else "FALSE"
    return f"""SELECT load_id, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(CASE WHEN isnan({number}) THEN 1 END) AS nans, count(CASE WHEN {wrong} THEN 1 END) AS malformed,
      min({fit}) AS min_num, max({fit}) AS max_num, min({text}) AS min_txt, max({text}) AS max_txt FROM trips GROUP BY load_id"""


ORACLES = {
    "p5_profile_exact": " UNION ALL ".join(_column_profile(c) for c in [*_NUMBERS, *_WHOLE, *_TIMES, *_TEXTS]),
    "p2_typed": _FEES + _AMOUNTS + f"""
        SELECT t.row_id, t.file_id, t.line_no, {', '.join(_typed(c, kind) for c, kind in drift.TRIP_SCHEMA.items())}, readable, a.amount AS airport_fee, c.amount AS cbd_congestion_fee
        FROM (SELECT *, payload IS NOT NULL AND json_valid(payload) AS readable FROM trip_file_rows) t
        LEFT JOIN o a ON t.row_id = a.row_id AND a.field = 'airport_fee' LEFT JOIN o c ON t.row_id = c.row_id AND c.field = 'cbd_congestion_fee'""",
    "p2_changes": _FEES + f""",
        g AS (SELECT file_id, coalesce(field, path) AS field, path, kind FROM f WHERE NOT (ty = 'NULL' AND path IN ({', '.join(repr(c) for c in drift.TRIP_SCHEMA)}))),
        k AS (SELECT file_id, field, string_agg(DISTINCT path, ', ' ORDER BY path) AS keys FROM g GROUP BY ALL),
        n AS (SELECT file_id, field, kind, count(*) AS n FROM g WHERE kind IS NOT NULL GROUP BY ALL),
        m AS (SELECT file_id, field, kind FROM n QUALIFY row_number() OVER (PARTITION BY file_id, field ORDER BY n DESC, kind) = 1),
        t AS (SELECT file_id, feed, file_seq FROM trip_files WHERE file_id IN (SELECT file_id FROM trip_file_rows)),
        h AS (SELECT DISTINCT t.feed, k.field FROM t JOIN k USING (file_id)),
        a AS (SELECT t.*, h.field, k.keys, m.kind FROM t JOIN h USING (feed) LEFT JOIN k ON k.file_id = t.file_id AND k.field = h.field LEFT JOIN m ON m.file_id = t.file_id AND m.field = h.field),
        b AS (SELECT *, lag(keys) OVER o AS keys0, lag(kind) OVER o AS kind0, row_number() OVER o AS place FROM a WINDOW o AS (PARTITION BY feed, field ORDER BY file_seq))
        SELECT file_id, field, 'added' AS change, NULL AS "before", keys AS "after" FROM b WHERE place > 1 AND keys IS NOT NULL AND keys0 IS NULL
        UNION ALL SELECT file_id, field, 'removed', keys0, NULL FROM b WHERE place > 1 AND keys IS NULL AND keys0 IS NOT NULL
        UNION ALL SELECT file_id, field, 'renamed', keys0, keys FROM b WHERE place > 1 AND keys <> keys0
        UNION ALL SELECT file_id, field, 'retyped', kind0, kind FROM b WHERE place > 1 AND keys IS NOT NULL AND keys0 IS NOT NULL AND kind <> kind0""",
    "p2_found": _FEES + """,
        k AS (SELECT file_id, field, string_agg(DISTINCT path, ', ' ORDER BY path) AS keys FROM f WHERE field IS NOT NULL GROUP BY ALL),
        n AS (SELECT file_id, field, kind, count(*) AS n FROM f WHERE field IS NOT NULL AND kind IS NOT NULL GROUP BY ALL),
        m AS (SELECT file_id, field, kind FROM n QUALIFY row_number() OVER (PARTITION BY file_id, field ORDER BY n DESC, kind) = 1),
        a AS (SELECT t.file_id, t.feed, t.file_seq, g.field, k.keys, m.kind FROM trip_files t JOIN (SELECT DISTINCT file_id FROM trip_file_rows) d ON t.file_id = d.file_id
              CROSS JOIN (VALUES ('airport_fee'), ('cbd_congestion_fee')) g(field) LEFT JOIN k ON k.file_id = t.file_id AND k.field = g.field LEFT JOIN m ON m.file_id = t.file_id AND m.field = g.field),
        b AS (SELECT *, lag(keys) OVER o AS keys0, lag(kind) OVER o AS kind0, row_number() OVER o AS place FROM a WINDOW o AS (PARTITION BY feed, field ORDER BY file_seq))
        SELECT file_id, field, 'added' AS change FROM b WHERE place > 1 AND keys IS NOT NULL AND keys0 IS NULL
        UNION ALL SELECT file_id, field, 'removed' FROM b WHERE place > 1 AND keys IS NULL AND keys0 IS NOT NULL
        UNION ALL SELECT file_id, field, 'renamed' FROM b WHERE place > 1 AND keys <> keys0
        UNION ALL SELECT file_id, field, 'retyped' FROM b WHERE place > 1 AND keys IS NOT NULL AND keys0 IS NOT NULL AND kind <> kind0""",
    "p2_fee_totals": _FEES + _AMOUNTS + """
        SELECT r.file_id, count(*) AS records, count(CASE WHEN readable THEN 1 END) AS readable_records, count(a.amount) AS airport_fees, count(c.amount) AS cbd_fees,
          round(coalesce(sum(a.amount), 0.0), 2) AS airport_sum, round(coalesce(sum(c.amount), 0.0), 2) AS cbd_sum
        FROM r LEFT JOIN o a ON r.row_id = a.row_id AND a.field = 'airport_fee' LEFT JOIN o c ON r.row_id = c.row_id AND c.field = 'cbd_congestion_fee' GROUP BY r.file_id""",
    "p3_found": f"""
        WITH b AS ({_BOTH}), t AS (SELECT count(*) AS n FROM trips)
        SELECT field, zone_id FROM b WHERE zone_id IS NOT NULL GROUP BY field, zone_id HAVING count(*) >= 0.03 * (SELECT n FROM t)""",
    "p3_zone_stats": f"""
        SELECT b.field, b.zone_id, z.Borough AS borough, count(*) AS rows,
          coalesce(sum(round({_FIN.format("base_passenger_fare")} * 100)), 0.0) AS sum_fare_cents,
          coalesce(sum(round({_FIN.format("trip_miles")} * 1000)), 0.0) AS sum_mile_thousandths,
          CAST(coalesce(sum(trip_time), 0) AS DOUBLE) AS sum_trip_time
        FROM ({_BOTH}) b LEFT JOIN taxi_zones z ON b.zone_id = z.LocationID GROUP BY b.field, b.zone_id, z.Borough""",
    "p3_borough_flows": f"""
        SELECT p.Borough AS pu_borough, q.Borough AS do_borough, count(*) AS rows,
          coalesce(sum(round({_FIN.format("base_passenger_fare")} * 100)), 0.0) AS sum_fare_cents,
          coalesce(sum(round({_FIN.format("trip_miles")} * 1000)), 0.0) AS sum_mile_thousandths
        FROM trips t JOIN taxi_zones p ON t.PULocationID = p.LocationID JOIN taxi_zones q ON t.DOLocationID = q.LocationID GROUP BY 1, 2""",
    "p3_chained_trips": """
        SELECT a.DOLocationID AS zone_id, count(*) AS pairs, CAST(sum(a.trip_time) AS DOUBLE) AS sum_trip_time
        FROM trips a JOIN trips b ON a.DOLocationID = b.PULocationID GROUP BY 1""",
    "p3_trip_ranks": f"""
        SELECT field, zone_id, record_id, row_number() OVER (PARTITION BY field, zone_id ORDER BY pickup_datetime NULLS FIRST, record_id) AS zone_rank FROM ({_BOTH})""",
    "p5_load_figures": _FIGURES + """
        SELECT load_id, column_name, rows, nulls, round(null_rate, 6) AS null_rate, distinct_values, round(bad_share, 6) AS bad_share,
          round(good_median, 6) AS good_median, round(share, 6) AS share FROM f""",
    "p5_found": _FIGURES + """,
        c AS (SELECT column_name, median(null_rate) AS mn, median(distinct_values) AS md, median(good_median) AS mm, median(share) AS ms FROM f GROUP BY column_name),
        j AS (SELECT * FROM f JOIN c USING (column_name))
        SELECT load_id, column_name, 'null_rate' AS finding FROM j WHERE null_rate >= mn + 0.10
        UNION ALL SELECT load_id, column_name, 'distinct_count' FROM j WHERE distinct_values >= 3 * md OR distinct_values * 3 <= md
        UNION ALL SELECT load_id, column_name, 'value_range' FROM j WHERE column_name <> 'wav_request_flag' AND bad_share >= 0.04
        UNION ALL SELECT load_id, column_name, 'pattern' FROM j WHERE column_name = 'wav_request_flag' AND bad_share >= 0.04
        UNION ALL SELECT load_id, column_name, 'distribution' FROM j WHERE column_name IN ('base_passenger_fare', 'trip_miles') AND (good_median >= 1.5 * mm OR good_median <= mm / 1.5)
        UNION ALL SELECT load_id, column_name, 'distribution' FROM j WHERE column_name IN ('airport_fee', 'wav_request_flag') AND abs(share - ms) >= 0.15""",
}
ORACLES["p5_found_incremental"] = ORACLES["p5_found"]
