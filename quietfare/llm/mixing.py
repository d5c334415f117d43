"""Mixing sources to target weights by hash thresholds.

Every record has a fixed pseudo-random place in its source (a hash of its id).
A source that must contribute more than it holds is taken whole as often as it
fits, and the rest is the records below a threshold of that place. Thresholds
are found from histograms: sizes are summed by source and leading hash bits, the
bucket in which the running sum passes the budget is found, and only the records
of that bucket are summed again by their next bits. Nothing is sorted, no row
but the boundary bucket's is looked at twice, and thresholds are nested: a
larger budget only adds records.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietfare.session import cut

HASH_BITS, STEP_BITS = 60, 12
MAX_SOURCES = 10_000


def hash_place(*columns: Column, seed: int = 42) -> Column:
    """A place of ``HASH_BITS`` bits from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 64 - HASH_BITS)


def plan(totals: dict[str, int], targets: dict[str, tuple[Fraction, int]], budget: int | None = None) -> dict[str, Fraction]:
    """The size each source shall contribute.

    Without ``budget`` it is the largest mix in which every non-empty source
    reaches its share exactly under its cap; with one, each source gets its share
    of it, or all its cap allows.
    """
    usable = {s: (w, r) for s, (w, r) in targets.items() if w > 0 and totals.get(s, 0) > 0 and r > 0}
    if not usable:
        return {}
    whole = Fraction(budget) if budget is not None else min(Fraction(r * totals[s]) / w for s, (w, r) in usable.items())
    return {s: min(w * whole, Fraction(r * totals[s])) for s, (w, r) in usable.items()}


def mix(items: DataFrame, targets: DataFrame, size: str, place: Column, source: str = "source", keep: tuple[str, ...] = ("doc_id",), budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares): the records to take with their ``repeats``, and what every target source reaches.

    ``targets`` has ``source``, ``target_share``, ``max_repeats``: one row per
    source, at most ``MAX_SOURCES`` (checked). Records of other or null sources,
    and of null or no size, are not chosen. Shares needn't sum to 1. A record's
    repeats never exceed its source's cap; a source's size misses its aim by at
    most half its boundary record. Records with the same place are taken or left
    together.
    """
    rows = targets.select("source", "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES or len({r.source for r in rows}) < len(rows):
        raise ValueError(f"targets must name at most {MAX_SOURCES} sources, each once")
    wanted = {r.source: (Fraction(str(r.target_share or 0)), int(r.max_repeats or 0)) for r in rows if r.source is not None}
    spark = items.sparkSession
    base = cut(items.where(F.col(source).isin(*wanted)).select(*keep, F.col(source).alias("source"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("size"), place.alias("place"))).where("size > 0")
    totals = {r.source: (int(r.size), int(r.n)) for r in base.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()}
    aims = plan({s: t for s, (t, _) in totals.items()}, wanted, budget)
    full = {s: int(a // totals[s][0]) for s, a in aims.items()}
    left = {s: a - full[s] * totals[s][0] for s, a in aims.items()}
    limit = _thresholds(base, {s: x for s, x in left.items() if x > 0})
    rules = [(s, full[s], limit.get(s, -1)) for s in aims]
    frame = F.broadcast(spark.createDataFrame(rules, "source string, full int, last bigint"))  # a row per target source
    chosen = base.join(frame, "source").withColumn("repeats", F.col("full") + (F.col("place") <= F.col("last")).cast("int")).where("repeats > 0").select(*keep, "source", "size", "repeats")
    got = chosen.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("chosen_size"), F.count(F.lit(1)).alias("chosen_records"), F.max("repeats").alias("most_repeats"))
    asked = spark.createDataFrame([(s, float(w), r, totals.get(s, (0, 0))[0], totals.get(s, (0, 0))[1]) for s, (w, r) in wanted.items()], "source string, target_share double, max_repeats int, available_size bigint, available_records bigint")
    shares = asked.join(got, "source", "left").fillna(0, ["chosen_size", "chosen_records", "most_repeats"])
    all_of = F.sum("chosen_size").over(Window.partitionBy(F.lit(1)))  # a row per target source
    return chosen, shares.withColumn("actual_share", F.when(all_of > 0, F.col("chosen_size") / all_of).otherwise(0.0))


def _thresholds(base: DataFrame, budgets: dict[str, Fraction]) -> dict[str, int]:
    """The last place to take in each source, so that the sizes up to it come nearest to the budget (-1: none)."""
    spark = base.sparkSession
    open_budgets = dict(budgets)
    prefix = dict.fromkeys(open_budgets, 0)
    found: dict[str, int] = {}
    rows = base
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        if not open_budgets:
            break
        state = spark.createDataFrame([(s, prefix[s], float(x)) for s, x in open_budgets.items()], "source string, prefix bigint, budget double")
        inside = rows.join(F.broadcast(state), "source").where(F.shiftright("place", shift + STEP_BITS) == F.col("prefix"))
        buckets = inside.groupBy("source", F.shiftright("place", shift).alias("bucket"), "budget").agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")  # at most 2**STEP_BITS rows a source
        summed = buckets.withColumn("upto", F.sum("size").over(running))
        # the bucket in which the budget is passed or met, and what comes before it
        edge = summed.where("upto >= budget").groupBy("source").agg(F.min(F.struct("bucket", "size", "upto")).alias("e")).select("source", "e.*").collect()
        edges = {r.source: r for r in edge}
        for s in list(open_budgets):
            if s not in edges:  # rounding: the whole source is wanted
                found[s] = ((prefix[s] + 1) << (shift + STEP_BITS)) - 1
                del open_budgets[s]
                continue
            e = edges[s]
            before = open_budgets[s] - (e.upto - e.size)
            if shift == 0:
                found[s] = e.bucket if 2 * before >= e.size else e.bucket - 1
            else:
                prefix[s], open_budgets[s] = e.bucket, before
        if shift and open_budgets:
            narrowed = spark.createDataFrame([(s, prefix[s]) for s in open_budgets], "source string, prefix bigint")
            rows = cut(rows.join(F.broadcast(narrowed), "source").where(F.shiftright("place", shift) == F.col("prefix")).select("source", "size", "place"))
    return found
