"""Queries of the text and language-model operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietfare.llm import digest, mixing, packing, personal, sentences, tokens
from quietfare.plans.export import export
from quietfare.plans.policy import POLICIES, load_policy
from quietfare.queries.common import table
from quietfare.queries.reference import SALT
from quietfare.session import cut

MEASURES = ["base_passenger_fare", "trip_time", "driver_pay"]
MOST_CAPACITIES = 1000
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every personal value in the support notes."""
    return personal.personal_spans(table(spark, d, "trips"), "support_note", ("record_id",))


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every support note with typed placeholders in place of its personal values."""
    notes = table(spark, d, "trips").where(F.col("support_note").isNotNull()).select("record_id", "support_note")
    return personal.redact_column(notes, "support_note").select("record_id", "redacted")


def export_tlc_personal(spark: SparkSession, d: str) -> DataFrame:
    """The row-level policy's release with notes redacted by the anchor parsers, which find names too."""
    policy, _ = load_policy(POLICIES / "tlc_trip_submission.yaml")
    return export(table(spark, d, "trips"), policy, SALT, detector=personal.note_detector)


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per load and pick-up zone, and per zone over all loads (null load_id) from the loads' digests, which are written once."""
    loads = cut(digest.digests(table(spark, d, "trips"), ["load_id", "PULocationID"], MEASURES))
    zones = digest.merge_digests(loads, ["PULocationID"])
    parts = loads.unionByName(zones.withColumn("load_id", F.lit(None).cast("bigint")).select(*loads.columns))
    return digest.read_quantiles(parts, QUANTILES)


def p4_zone_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per pick-up zone, digested directly."""
    return digest.read_quantiles(digest.digests(table(spark, d, "trips"), ["PULocationID"], MEASURES), QUANTILES).drop("rank_error")


def p4_rank_check(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles over all rows, compressed, against the exact ranks of their values: whether each keeps its stated rank error."""
    trips = table(spark, d, "trips")
    found = digest.read_quantiles(digest.digests(trips, [], MEASURES), QUANTILES)
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(q).alias("q"), F.col(name).alias("value")) for name, q in QUANTILES.items()]))
    wanted = digest.with_leaf(found.select("column_name", "n", "rank_error", pairs.alias("_q")).select("column_name", "n", "rank_error", "_q.*"))
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in MEASURES]))
    leaves = digest.with_leaf(trips.select(values.alias("_v")).select("_v.*").where("value is not null and not isnan(value)")).groupBy("column_name", F.col("_leaf").alias("_l")).agg(F.count(F.lit(1)).alias("c"))
    ranks = leaves.join(wanted, "column_name").groupBy("column_name", "quantile", "q", "n", "rank_error").agg(F.sum(F.when(F.col("_l") < F.col("_leaf"), F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("_l") <= F.col("_leaf"), F.col("c")).otherwise(0)).alias("upto"))
    rank = F.ceil(F.round(F.col("q") * F.col("n"), 9))
    off = F.greatest(F.col("below") + 1 - rank, rank - F.col("upto"), F.lit(0))
    return ranks.select("column_name", "quantile", "n", (F.col("rank_error") > 0).alias("compressed"), (off <= F.col("rank_error")).alias("within"))


def _capacities(spark: SparkSession, d: str) -> dict[int, int]:
    rows = table(spark, d, "pack_capacities").limit(MOST_CAPACITIES + 1).collect()
    if len(rows) > MOST_CAPACITIES:
        raise ValueError(f"pack_capacities has more than {MOST_CAPACITIES} rows")
    return {r.capacity_id: r.capacity_tokens for r in rows}


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    """Every document in containers of every capacity."""
    return packing.pack(table(spark, d, "documents"), _capacities(spark, d))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers and fill per capacity."""
    return packing.fill_report(p6_pack(spark, d), _capacities(spark, d))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """What every packing keeps, on the documents' characters: all items and their whole size placed, none split that fits, no container overfull, few containers."""
    caps = _capacities(spark, d)
    packed = packing.pack(table(spark, d, "documents"), caps, size="n_chars", text=None)
    cap = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])[F.col("capacity_id")]
    items = packed.groupBy("capacity_id", "doc_id").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("pieces"))
    by_item = items.groupBy("capacity_id").agg(F.count(F.lit(1)).alias("items"), F.sum("size").alias("size"), F.sum("pieces").alias("pieces"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= cap)).alias("split_though_fitting"))
    containers = packed.groupBy("capacity_id", "container_id").agg(F.sum("size").alias("used"))
    by_container = containers.groupBy("capacity_id").agg(F.count_if(F.col("used") > cap).alias("overfull"), F.count(F.lit(1)).alias("containers"))
    # a packing is few containers if no two half-empty ones could have been joined: at most twice the size, and one
    few = F.col("containers") * cap <= 2 * F.col("size") + cap
    return by_item.join(by_container, "capacity_id").select("capacity_id", "items", "size", "pieces", "split_though_fitting", "overfull", few.alias("few_containers"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return tokens.with_token_counts(table(spark, d, "documents").select("doc_id", "source", "text"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents with their repeats."""
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"), "tokens", mixing.hash_place(F.col("doc_id")))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of all tokens each source reaches."""
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"), "tokens", mixing.hash_place(F.col("doc_id")))[1]


def p7_mix_by_chars(spark: SparkSession, d: str) -> DataFrame:
    """The same operator on the documents' characters, and places from MD5, which SQL can express too."""
    place = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("|42"))), 1, 15), 16, 10).cast("bigint")
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "n_chars", place)[0]


def p7_shares_by_chars(spark: SparkSession, d: str) -> DataFrame:
    """What each source reaches in that mix."""
    place = F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("|42"))), 1, 15), 16, 10).cast("bigint")
    shares = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "n_chars", place)[1]
    return shares.select("source", "available_size", "available_records", "chosen_size", "chosen_records", "most_repeats", F.round("actual_share", 6).alias("actual_share"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The sentence units of every document."""
    return sentences.split_sentences(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_redacted, p4_percentiles, p4_zone_percentiles, p4_rank_check, p6_pack, p6_fill, p6_checks, p7_mix, p7_shares, p7_mix_by_chars, p7_shares_by_chars, p8_found, export_tlc_personal)}

def _quantile(q: float) -> str:
    return f"max(CASE WHEN r = CAST(ceil(round({q} * n, 9)) AS BIGINT) THEN v END)"


def _percentiles(keys: str) -> str:
    """Exact percentiles of the quantised values; the digests are exact below their factor k, so on small tables both agree."""
    return f"""
        SELECT {keys}, column_name, max(n) AS n, {", ".join(f"{_quantile(q)} AS {name}" for name, q in QUANTILES.items())}
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, column_name ORDER BY leaf) AS r, count(*) OVER (PARTITION BY {keys}, column_name) AS n FROM w) GROUP BY {keys}, column_name"""


_VALUES = f"""
        WITH t AS (SELECT load_id, PULocationID, 'base_passenger_fare' AS column_name, base_passenger_fare AS value FROM trips
                   UNION ALL SELECT load_id, PULocationID, 'trip_time', CAST(trip_time AS DOUBLE) FROM trips
                   UNION ALL SELECT load_id, PULocationID, 'driver_pay', driver_pay FROM trips),
        l AS (SELECT load_id, PULocationID, column_name, {digest.leaf_sql("value")} AS leaf FROM t),
        m AS (SELECT *, CASE WHEN leaf >= {digest.HALF} THEN leaf - {digest.HALF} ELSE {digest.HALF - 1} - leaf END AS g FROM l WHERE leaf IS NOT NULL),
        w AS (SELECT load_id, PULocationID, column_name, leaf,
                CASE WHEN leaf >= {digest.HALF} THEN 1.0 ELSE -1.0 END * CASE WHEN g = 0 THEN 0.0 WHEN g = {digest.HALF - 1} THEN CAST('Infinity' AS DOUBLE)
                  ELSE power(2.0, floor(g / {float(1 << digest.MANTISSA_BITS)}) - {-digest.EXPONENT_LOW}) * (1.0 + (g % {1 << digest.MANTISSA_BITS}) / {float(1 << digest.MANTISSA_BITS)}) END AS v FROM m)"""

_MIX = """
        WITH i AS (SELECT d.doc_id, d.source, d.n_chars AS size, t.target_share AS w, t.max_repeats AS r,
                     CAST('0x' || substr(md5(CAST(d.doc_id AS VARCHAR) || '|42'), 1, 15) AS BIGINT) AS place
                   FROM documents d JOIN mix_targets t ON d.source = t.source WHERE d.n_chars > 0),
        s AS (SELECT source, max(w) AS w, max(r) AS r, sum(size) AS total FROM i GROUP BY source),
        b AS (SELECT min(r * total / w) AS budget FROM s),
        a AS (SELECT source, total, CAST(floor(least(w * budget, r * total) / total + 1e-9) AS BIGINT) AS copies, least(w * budget, r * total) AS aim FROM s, b),
        c AS (SELECT i.*, a.copies, a.aim - a.copies * a.total AS budget, sum(size) OVER (PARTITION BY i.source ORDER BY place) AS upto FROM i JOIN a ON i.source = a.source),
        e AS (SELECT *, copies + CASE WHEN upto < budget OR (upto - size < budget AND 2 * (budget - (upto - size)) >= size) THEN 1 ELSE 0 END AS repeats FROM c)"""

ORACLES = {
    "p4_rank_check": " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{q}' AS quantile, count({c}) FILTER (NOT isnan(CAST({c} AS DOUBLE))) AS n, count({c}) FILTER (NOT isnan(CAST({c} AS DOUBLE))) > 4400 AS compressed, TRUE AS within FROM trips" for c in MEASURES for q in QUANTILES),
    "p4_zone_percentiles": _VALUES + _percentiles("PULocationID"),
    "p4_percentiles": f"{_VALUES} SELECT *, CAST(0 AS BIGINT) AS rank_error FROM ({_percentiles('load_id, PULocationID')} UNION ALL SELECT CAST(NULL AS BIGINT) AS load_id, * FROM ({_percentiles('PULocationID')}))",
    "p6_checks": """
        SELECT c.capacity_id, count(*) AS items, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS size, CAST(sum(greatest(1, ceil(coalesce(n_chars, 0) / CAST(c.capacity_tokens AS DOUBLE)))) AS BIGINT) AS pieces,
          CAST(0 AS BIGINT) AS split_though_fitting, CAST(0 AS BIGINT) AS overfull, TRUE AS few_containers
        FROM documents, pack_capacities c GROUP BY c.capacity_id""",
    "p7_mix_by_chars": _MIX + """
        SELECT doc_id, source, size, CAST(repeats AS INTEGER) AS repeats FROM e WHERE repeats > 0""",
    "p7_shares_by_chars": _MIX + """,
        g AS (SELECT source, sum(size * repeats) AS chosen_size, count(*) AS chosen_records, max(repeats) AS most_repeats FROM e WHERE repeats > 0 GROUP BY source),
        n AS (SELECT source, sum(size) AS available_size, count(*) AS available_records FROM i GROUP BY source)
        SELECT t.source, CAST(coalesce(available_size, 0) AS BIGINT) AS available_size, coalesce(available_records, 0) AS available_records, CAST(coalesce(chosen_size, 0) AS BIGINT) AS chosen_size,
          coalesce(chosen_records, 0) AS chosen_records, CAST(coalesce(most_repeats, 0) AS INTEGER) AS most_repeats, round(coalesce(chosen_size, 0) / (SELECT CAST(sum(chosen_size) AS DOUBLE) FROM g), 6) AS actual_share
        FROM mix_targets t LEFT JOIN g ON t.source = g.source LEFT JOIN n ON t.source = n.source""",
}
