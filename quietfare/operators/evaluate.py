"""Precision, recall and F1 of detected spans against gold spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietfare.functions.spans import greedy_matches
from quietfare.schemas import SPANS


def nest_spans(labels: DataFrame, key: str) -> DataFrame:
    """Label rows (key, entity_type, start, end) as one array per key, in order of start."""
    span = F.struct("start", "end", "entity_type")
    nested = labels.groupBy(key).agg(F.array_sort(F.collect_list(span)).alias("gold"))
    return nested.withColumn("gold", F.transform("gold", lambda s: F.struct(s["entity_type"].alias("entity_type"), s["start"].alias("start"), s["end"].alias("end"), F.lit(1.0).alias("score"))))


def align(notes: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Notes with their gold spans; a note without labels gets an empty array."""
    return notes.join(nest_spans(labels, key), key, "left").withColumn("gold", F.coalesce("gold", F.array().cast(SPANS)))


def outcomes(df: DataFrame, gold: str = "gold", found: str = "found") -> DataFrame:
    """``entity``, ``tp``, ``fp``, ``fn`` per type, from rows with a gold and a detected array. The matching is one fold per row."""
    matched = df.select(gold, found, greedy_matches(F.col(gold), F.col(found)).alias("_m"))
    label = lambda spans, side, hit, miss: F.transform(
        spans, lambda s, i: F.struct(s["entity_type"].alias("entity"), F.when(F.exists("_m", lambda m: m[side] == i), hit).otherwise(miss).alias("outcome"))
    )
    both = F.concat(label(F.col(gold), "g", "tp", "fn"), F.filter(label(F.col(found), "d", "seen", "fp"), lambda s: s["outcome"] == "fp"))
    return matched.select(F.explode(both).alias("o")).groupBy("o.entity").agg(*[F.count_if(F.col("o.outcome") == x).alias(x) for x in ("tp", "fp", "fn")])


def scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per type and overall (``entity`` = overall); 0 where their base is empty."""
    total = counts.rollup("entity").agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn")]).withColumn("entity", F.coalesce("entity", F.lit("overall")))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return total.select(
        "entity", "tp", "fp", "fn", F.round(ratio(tp, tp + fp), 4).alias("precision"), F.round(ratio(tp, tp + fn), 4).alias("recall"), F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1")
    )


def meets_targets(scored: DataFrame, recall: float = 0.95, precision: float = 0.90) -> DataFrame:
    """One row: whether the overall scores reach their targets."""
    return scored.where("entity = 'overall'").select("precision", "recall", ((F.col("recall") >= recall) & (F.col("precision") >= precision)).alias("passed"))
