"""Contract, soft rules, one-pass profile and health score. A rule is a named boolean Column, reused for counting, flagging and filtering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietfare import schemas as S
from quietfare.functions.temporal import nan_to_null, seconds_between

TOLERANCE_SECONDS = 60


def clean(df: DataFrame, columns: Sequence[str] = (*S.MONEY_COLUMNS, "trip_miles")) -> DataFrame:
    """``df`` with NaN as null in the number columns that are there."""
    return df.withColumns({c: nan_to_null(F.col(c)) for c in columns if c in df.columns})


def any_of(rules: dict[str, Column]) -> Column:
    out = F.lit(False)
    for rule in rules.values():
        out = out | F.coalesce(rule, F.lit(False))
    return out


def validity_rules(null_flag_is_invalid: bool = True) -> dict[str, Column]:
    """Negative amounts and miles; flags other than Y and N (a null flag too, unless told otherwise)."""
    rules = {f"{c}_negative": F.col(c) < 0 for c in (*S.MONEY_COLUMNS, "trip_miles")}
    for c in S.FLAG_COLUMNS:
        rules[f"{c}_not_YN"] = ~F.coalesce(F.col(c).isin("Y", "N"), F.lit(not null_flag_is_invalid))
    return rules


def consistency_rules(tolerance: int = TOLERANCE_SECONDS) -> dict[str, Column]:
    duration = seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return {"dropoff_before_pickup": F.col("dropoff_datetime") < F.col("pickup_datetime"), "trip_time_mismatch": F.abs(F.col("trip_time") - duration) > tolerance}


def contract_rules(license_number: str = S.LICENSE) -> dict[str, Column]:
    """Hard rules: required values, licence, zone range, no negative miles or time."""
    rules = {f"{c}:not_nullable": F.col(c).isNull() for c in S.REQUIRED_COLUMNS}
    rules["hvfhs_license_num:isin"] = F.col("hvfhs_license_num") != license_number
    for c in ("PULocationID", "DOLocationID"):
        rules[f"{c}:in_range"] = ~F.col(c).between(*S.ZONES)
    rules |= {f"{c}:ge_0": F.col(c) < 0 for c in ("trip_miles", "trip_time")}
    return rules


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rule``, ``n``: rows that fail each rule, from one aggregate."""
    row = df.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n")) for i, name in enumerate(rules)])
    return row.select(F.inline(pairs))


def contract_failures(df: DataFrame, license_number: str = S.LICENSE) -> DataFrame:
    """``column``, ``check``, ``n``: the contract's failures, missing columns included; empty if it holds.

    A column of another type is cast to the contract's; values that are there but
    don't cast fail as ``coerce_dtype`` and count in no other check.
    """
    missing = [c for c in S.REAL_COLUMNS if c not in df.columns]
    kinds = {c: t for c, t in S.CONTRACT_TYPES.items() if c not in missing and df.schema[c].dataType.simpleString() not in (t, "int" if t == "bigint" else t)}
    uncast = {f"{c}:coerce_dtype": F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull() for c in kinds}
    typed = df.withColumns({f"_raw_{c}": F.col(c) for c in kinds}).withColumns({c: F.col(c).try_cast(t) for c, t in kinds.items()}) if kinds else df
    rules = {k: v for k, v in contract_rules(license_number).items() if k.split(":")[0] not in missing}
    for c in kinds:
        if f"{c}:not_nullable" in rules:
            rules[f"{c}:not_nullable"] = F.col(f"_raw_{c}").isNull()
    counts = rule_counts(clean(typed), rules | uncast).where("n > 0").select(F.split_part("rule", F.lit(":"), F.lit(1)).alias("column"), F.split_part("rule", F.lit(":"), F.lit(2)).alias("check"), "n")
    if not missing:
        return counts
    return counts.unionByName(df.sparkSession.createDataFrame([(c, "column_in_dataframe", 1) for c in missing], "column string, check string, n bigint"))


def uncastable(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``column``, ``n``: values that are there but don't cast to the contract's type."""
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in types])))


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, ``duplicate_rows``: rows beyond the first of each distinct tuple; nulls equal nulls.

    Rows are grouped by two independent 64-bit hashes of the tuple and of the
    places of its nulls, so 16 bytes a row are shuffled instead of the wide
    columns. Two different tuples of ``n`` rows fall together with a probability
    of about ``n * n / 2**129``, 1e-15 for a trillion rows.
    """
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    keyed = df.select(F.xxhash64(nulls, *[F.col(c) for c in columns]).alias("_h"), F.xxhash64(F.lit("second"), nulls, *[F.col(c) for c in columns]).alias("_k"))
    return keyed.groupBy("_h", "_k").agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def profile(df: DataFrame, license_number: str = S.LICENSE, null_flag_is_invalid: bool = True) -> DataFrame:
    """One row of nine counts: the profile in one scan, the duplicates' hashes in a second one of the same columns."""
    data = clean(df)
    nulls = lambda columns: sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    zones = ~F.col("PULocationID").between(*S.ZONES) | ~F.col("DOLocationID").between(*S.ZONES)
    wide = data.agg(
        F.count(F.lit(1)).alias("n"), nulls(S.REAL_COLUMNS).alias("null_cells"), nulls(S.REQUIRED_COLUMNS).alias("required_nulls"),
        F.count_if(zones).alias("zone_out_of_range"), F.count_if(F.col("trip_time") < 0).alias("trip_time_negative"), F.count_if(F.col("hvfhs_license_num") != license_number).alias("license_bad"),
        F.count_if(any_of(validity_rules(null_flag_is_invalid))).alias("validity_fail_rows"), F.count_if(any_of(consistency_rules())).alias("consistency_fail_rows"),
    )
    parts = wide.unionByName(duplicate_rows(data, S.REAL_COLUMNS), allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def health(profiled: DataFrame, threshold: float = 90.0) -> DataFrame:
    """Dimension scores, composite and gate of a profile row. No score, and refused, where the contract fails; empty data score 100."""
    rows = F.col("n")
    score = lambda fails, base: F.round(F.when(base > 0, (1 - fails / base) * 100).otherwise(100.0), 4)
    scored = profiled.select(
        "n", (F.col("required_nulls") + F.col("zone_out_of_range") + F.col("trip_time_negative") + F.col("license_bad") == 0).alias("tier1_passed"),
        score(F.col("null_cells"), rows * len(S.REAL_COLUMNS)).alias("completeness"), score(F.col("validity_fail_rows"), rows).alias("validity"),
        score(F.col("consistency_fail_rows"), rows).alias("consistency"), score(F.col("duplicate_rows"), rows).alias("uniqueness"),
    )
    mean = F.round((F.col("completeness") + F.col("validity") + F.col("consistency") + F.col("uniqueness")) / 4, 4)
    out = scored.withColumn("health_score", F.when(F.col("tier1_passed"), mean))
    return out.withColumn("refused", F.coalesce(F.col("health_score") < threshold, F.lit(True)))


def null_cells(df: DataFrame, columns: Sequence[str] = S.REAL_COLUMNS) -> DataFrame:
    """``column``, ``n``: nulls (NaN included) per column."""
    return rule_counts(clean(df), {c: F.col(c).isNull() for c in columns}).withColumnRenamed("rule", "column")


def money_profile(df: DataFrame, columns: Sequence[str] = S.MONEY_COLUMNS) -> DataFrame:
    """``column``, ``min``, ``max``, ``negatives``, ``zeros`` per amount, of finite values."""
    finite = {c: F.when(F.abs(nan_to_null(F.col(c))) < float("inf"), F.col(c)) for c in columns}
    aggs = [x for c, v in finite.items() for x in (F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max"), F.count_if(v < 0).alias(f"{c}_neg"), F.count_if(v == 0).alias(f"{c}_zero"))]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_min").alias("min"), F.col(f"{c}_max").alias("max"), F.col(f"{c}_neg").alias("negatives"), F.col(f"{c}_zero").alias("zeros")) for c in columns]
    return row.select(F.inline(F.array(*parts)))
