"""Text spans as arrays of structs: finding, sorting out and redacting them inside the JVM."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietfare.schemas import SPANS


@dataclass(frozen=True)
class Recognizer:
    """A pattern with its score and the words before a match that raise it."""

    entity_type: str
    pattern: str
    score: float
    context: tuple[str, ...] = ()
    check: str | None = None


def luhn_valid(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn checksum."""
    digits = F.reverse(F.filter(F.split(F.regexp_replace(value, "[^0-9]", ""), ""), lambda x: x != ""))
    doubled = lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))
    total = F.aggregate(F.transform(F.transform(digits, lambda x: x.cast("int")), doubled), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


# Patterns, scores and context words of the note recognizers.
RECOGNIZERS = [
    Recognizer("TLC_LICENSE", r"(?i)\b\d{6,7}\b", 0.3, ("tlc", "license", "lic", "medallion", "hack", "driver")),
    Recognizer("NY_PLATE", r"(?i)\b[A-Z]{3}-?\d{4}\b", 0.6, ("plate", "license plate", "tag", "vehicle")),
    Recognizer("VEHICLE_VIN", r"(?i)\b[A-HJ-NPR-Z0-9]{17}\b", 0.7, ("vin", "vehicle", "chassis")),
    Recognizer("CREDIT_CARD", r"(?i)(?:\*{4}|x{4}|(?:xxxx[- ]?){3})\d{4}", 0.7, ("card", "ending", "charged", "payment")),
    Recognizer("PHONE_NUMBER", r"(?<!\d)(?:\(\d{3}\)\s?|\d{3}[.\s-]?)\d{3}[.\s-]?\d{4}(?!\d)", 0.8, ("phone", "call", "called", "reachable", "contact", "number")),
    Recognizer("LOCATION", r"\b\d{1,5}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2}", 0.9, ("near", "pickup", "dropoff", "address", "located", "corner", "block")),
    Recognizer("CREDIT_CARD", r"(?<![\d-])(?:\d[ -]?){12,18}\d(?![\d-])", 0.9, check="luhn"),
    Recognizer("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0.8),
]
THRESHOLD = 0.5
BOOST, FLOOR, CONTEXT_WORDS = 0.35, 0.4, 5
NEAR = 400  # characters before a match that hold its five words


def matches(text: Column, recognizer: Recognizer) -> Column:
    """Spans of all matches with offsets and score.

    Offsets are the running lengths of the pieces between the matches. With
    context words, a match whose five words before it contain one scores 0.35
    more (at least 0.4, at most 1). Null text gives no span.
    """
    pattern = F.lit(recognizer.pattern)
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, recognizer.pattern, -1)
    lengths = F.zip_with(between, values, lambda gap, value: F.struct(F.length(gap).alias("gap"), F.length(value).alias("size")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    placed = F.aggregate(
        F.filter(lengths, lambda x: x["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )

    def scored(span: Column) -> Column:
        score = F.lit(recognizer.score)
        if recognizer.context:
            near_text = F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - NEAR), F.least(span["start"], F.lit(NEAR)))
            before = F.split(F.trim(F.lower(near_text)), r"\s+")
            near = F.array_join(F.slice(before, F.greatest(F.lit(1), F.size(before) - CONTEXT_WORDS + 1), CONTEXT_WORDS), " ")
            words = "|".join(re.escape(w) for w in recognizer.context)
            score = F.when(near.rlike(words), F.least(F.lit(1.0), F.greatest(score + BOOST, F.lit(FLOOR)))).otherwise(score)
        return F.struct(F.lit(recognizer.entity_type).alias("entity_type"), span["start"].alias("start"), span["end"].alias("end"), score.alias("score"))

    if recognizer.check == "luhn":
        placed = F.filter(placed, lambda span: luhn_valid(F.substring(text, span["start"] + 1, span["end"] - span["start"])))
    return F.coalesce(F.when(F.size(values) > 0, F.transform(placed, scored)), F.array().cast(SPANS))


def deconflict(spans: Column) -> Column:
    """Spans without overlaps: the higher score wins, then the longer, then the earlier; in order of their start."""

    def order(a: Column, b: Column) -> Column:
        longer = (b["end"] - b["start"]) - (a["end"] - a["start"])
        return F.when(a["score"] != b["score"], F.signum(b["score"] - a["score"]).cast("int")).when(longer != 0, longer).otherwise(a["start"] - b["start"])

    kept = F.aggregate(
        F.array_sort(spans, order),
        F.array().cast(SPANS),
        lambda out, v: F.when(F.exists(out, lambda o: (v["start"] < o["end"]) & (o["start"] < v["end"])), out).otherwise(F.concat(out, F.array(v))),
    )
    return F.array_sort(kept, lambda a, b: a["start"] - b["start"])


def scan(text: Column, recognizers: list[Recognizer] = RECOGNIZERS, threshold: float = THRESHOLD) -> Column:
    """All recognizers' spans at or above the threshold, without overlaps."""
    found = F.concat(*[matches(text, r) for r in recognizers])
    return deconflict(F.filter(found, lambda s: s["score"] >= threshold))


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with every span replaced, built once from the pieces between the spans; null for null text."""
    ordered = F.array_sort(spans, lambda a, b: a["start"] - b["start"])

    def piece(span: Column, i: Column) -> Column:
        since = F.when(i > 0, F.get(ordered, i - 1)["end"]).otherwise(0)
        return F.concat(F.substring(text, since + 1, span["start"] - since), F.lit(mask))

    tail = F.coalesce(F.get(ordered, F.size(ordered) - 1)["end"], F.lit(0))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(ordered, piece), ""), F.substring(text, tail + 1, F.length(text)))).otherwise(text)


def greedy_matches(gold: Column, found: Column) -> Column:
    """One-to-one matches of detections with gold spans of the same type that overlap: ``array<struct<g, d>>`` of places.

    Gold spans are taken in order, each takes the first free detection. A fold
    inside the row: no join, no shuffle.
    """
    pairs = F.array().cast("array<struct<g:int,d:int>>")
    detections = F.transform(found, lambda s, i: F.struct(i.alias("d"), s["entity_type"].alias("t"), s["start"].alias("a"), s["end"].alias("b")))
    golds = F.transform(gold, lambda s, i: F.struct(i.alias("g"), s["entity_type"].alias("t"), s["start"].alias("a"), s["end"].alias("b")))

    def take(out: Column, g: Column) -> Column:
        free = F.filter(detections, lambda d: (d["t"] == g["t"]) & (d["a"] < g["b"]) & (g["a"] < d["b"]) & ~F.exists(out, lambda o: o["d"] == d["d"]))
        return F.when(F.size(free) > 0, F.concat(out, F.array(F.struct(g["g"].alias("g"), F.get(free, F.lit(0))["d"].alias("d"))))).otherwise(out)

    return F.aggregate(golds, pairs, take)


def rescan(text: Column, recognizers: list[Recognizer] = RECOGNIZERS) -> Column:
    """``struct<text, masked>``: a text to be given out, with every span that is found in it masked, and how many there were; null for null."""
    found = scan(text, recognizers)
    return F.when(text.isNotNull(), F.struct(redact(text, found).alias("text"), F.size(found).alias("masked")))
