"""Tidy tables of a ledger: one flat DataFrame per subject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRY = """seq bigint, timestamp_utc string, command string, operator string, entry_hash string, source string, policy_name string, output_kind string,
rows_in bigint, rows_out bigint, cells_suppressed bigint, k_achieved bigint, refused boolean, approval_id string, gate struct<health_score:double,refused:boolean>,
metrics struct<source:string,health_score:double,refused:boolean,request_id:string,verdict:string,profile:string,pii_redacted_in_draft:bigint,ladder:array<struct<qi:string,uniqueness:double>>>"""


def entries(lines: DataFrame) -> DataFrame:
    """Ledger lines as typed entries."""
    return lines.select(F.from_json("line", ENTRY).alias("e")).select("e.*")


def month_of(source: Column, dev_month: str) -> Column:
    return F.when(source.startswith("month:"), F.substring_index(source, ":", -1)).when(source == "dev", F.lit(dev_month)).when(source != "", source)


def scope_of(source: Column) -> Column:
    return F.when(source == "dev", "dev").when(source != "", "month")


def ledger_events(e: DataFrame) -> DataFrame:
    return e.select("seq", "timestamp_utc", "command", "operator", F.substring("entry_hash", 1, 16).alias("entry_hash"))


def exports(e: DataFrame, dev_month: str) -> DataFrame:
    rate = F.when(F.col("rows_in") > 0, F.col("cells_suppressed") / F.col("rows_in"))
    return e.where("command = 'export'").select(
        "timestamp_utc", month_of(F.col("source"), dev_month).alias("month"), scope_of(F.col("source")).alias("scope"), "policy_name", "output_kind",
        "rows_in", "rows_out", "cells_suppressed", rate.alias("suppression_rate"), "k_achieved", F.col("gate.health_score").alias("health_score"), "refused",
    )


def validation(e: DataFrame, dev_month: str) -> DataFrame:
    source = F.col("metrics.source")
    return e.where("command = 'validate'").select(
        "timestamp_utc", month_of(source, dev_month).alias("month"), scope_of(source).alias("scope"), F.col("metrics.health_score").alias("health_score"), F.col("metrics.refused").alias("refused")
    )


def uniqueness(e: DataFrame, dev_month: str) -> DataFrame:
    """The risk entries' ladders, a row per rung."""
    rungs = e.where("command = 'risk'").select("source", F.explode("metrics.ladder").alias("rung"))
    return rungs.select(month_of(F.col("source"), dev_month).alias("month"), scope_of(F.col("source")).alias("scope"), "rung.qi", "rung.uniqueness")


def suppression(reports: DataFrame) -> DataFrame:
    """Risk reports (``source``, ``suppression`` array), a row per quasi-identifier."""
    rows = reports.select("source", F.explode("suppression").alias("s"))
    return rows.select(F.regexp_replace("source", "^month:", "").alias("month"), "s.qi", "s.k", "s.suppressed", "s.rows_out")


def triage(e: DataFrame) -> DataFrame:
    return e.where("command = 'triage'").select("timestamp_utc", "metrics.request_id", "metrics.verdict", "metrics.profile", "metrics.pii_redacted_in_draft")


def requests(e: DataFrame) -> DataFrame:
    """Per request: the times of its last triage, approval and export, and hours from the first to the last."""
    last = lambda where, key, name: e.where(where).groupBy(F.col(key).alias("request_id")).agg(F.max_by("timestamp_utc", "seq").alias(name)).where("request_id is not null")
    out = last("command = 'triage'", "metrics.request_id", "triage_utc").join(last("command = 'approve'", "metrics.request_id", "approved_utc"), "request_id", "left")
    out = out.join(last("command = 'export'", "approval_id", "exported_utc"), "request_id", "left")
    hours = (F.unix_micros(F.to_timestamp("exported_utc")) - F.unix_micros(F.to_timestamp("triage_utc"))) / F.lit(3.6e9)
    return out.withColumn("turnaround_hours", hours)


def trend(table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The last value per key."""
    return table.groupBy(key).agg(F.max_by(value, order).alias(value))


#: Rungs of the uniqueness figure from the finest quasi-identifier to the coarsest.
LADDER_ORDER = ("zone x minute", "zone x 15 min", "zone x 60 min", "borough x 15 min")


def ladder_figure(ladder: DataFrame, order: tuple[str, ...] = LADDER_ORDER) -> DataFrame:
    """``position``, ``qi``, ``percent``: the known rungs in the figure's order; others are left out of the figure."""
    position = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("qi"))
    return ladder.where(position > 0).select(position.cast("int").alias("position"), "qi", F.round(F.col("uniqueness") * 100, 2).alias("percent"))


def suppression_trend(classes: DataFrame, by: str, k: int = 5) -> DataFrame:
    """``by``, ``rows``, ``percent``: the share of rows in classes below ``k`` per ``by``, from class sizes ``sz``."""
    small = F.coalesce(F.sum(F.when(F.col("sz") < k, F.col("sz"))), F.lit(0))
    return classes.groupBy(by).agg(F.sum("sz").alias("rows"), F.round(small / F.sum("sz") * 100, 2).alias("percent"))


def detection(scores: DataFrame) -> DataFrame:
    """``entity``, ``precision``, ``recall``, ``f1``: the tidy detection table, overall included."""
    return scores.select("entity", "precision", "recall", "f1")
