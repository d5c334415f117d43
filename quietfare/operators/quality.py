"""Column-level data quality: declarative checks, mergeable states, control limits.

A *check* is data: a column, a figure (a share of values that a predicate counts,
the number of distinct values, or the median of the values a predicate keeps) and,
where the figure is to be watched, a limit against all loads. All checks of a
table compile into one shared aggregate over value states, which come out of one
scan and merge by addition (:func:`value_states`), so a new load is profiled
alone and the history is only re-read as states. :func:`profile_states` are the
sketch states of every column. Figures of a load are then held against control
limits taken from all loads.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietfare.session import spread

Predicate = Callable[[Column], Column]

present: Predicate = lambda v: v.isNotNull()
absent: Predicate = lambda v: v.isNull()
good: Predicate = lambda v: ~F.isnan(v) & (v >= 0) & (v != float("inf"))


@dataclass(frozen=True)
class Limit:
    """When a load's figure is a finding: its ``amount`` against the median over all loads (rise, factor, shift) or by itself (level)."""

    finding: str
    kind: str
    amount: float

    def broken(self, value: Column, center: Column) -> Column:
        if self.kind == "level":
            return value >= self.amount
        if self.kind == "rise":
            return value >= center + self.amount
        if self.kind == "shift":
            return F.abs(value - center) >= self.amount
        if self.kind == "factor":
            return (value >= self.amount * center) | (value * self.amount <= center)
        if self.kind == "ratio":
            return (value >= self.amount * center) | (value <= center / self.amount)
        raise ValueError(f"unknown limit {self.kind}")


@dataclass(frozen=True)
class Check:
    """One declared figure of a column, and its limit if it has one.

    ``kind`` is share (of the rows' values in ``base``, those that ``counted``
    keeps), distinct, or median (of the values that ``counted`` keeps). ``text``
    columns hand text to the predicates, others doubles; a null predicate counts
    nothing.
    """

    column: str
    figure: str
    kind: str
    counted: Predicate = present
    base: Predicate | None = None  # none: all rows
    limit: Limit | None = None
    text: bool = False


def number_checks(column: str, by_median: bool, upper: float = 1000.0) -> list[Check]:
    """Null rate, distinct values, values out of range, and the good values' median or share above 0."""
    return [
        Check(column, "null_rate", "share", absent, None, Limit("null_rate", "rise", 0.10)),
        Check(column, "distinct_values", "distinct", limit=Limit("distinct_count", "factor", 3.0)),
        Check(column, "bad_share", "share", lambda v: ~(good(v) & (v <= upper)), present, Limit("value_range", "level", 0.04)),
        Check(column, "good_median", "median", good, limit=Limit("distribution", "ratio", 1.5) if by_median else None),
        Check(column, "share", "share", lambda v: good(v) & (v > 0), good, None if by_median else Limit("distribution", "shift", 0.15)),
    ]


def flag_checks(column: str, allowed: tuple[str, ...] = ("Y", "N")) -> list[Check]:
    """Null rate, distinct values, values that aren't allowed, and the share of the first allowed one."""
    return [
        Check(column, "null_rate", "share", absent, None, Limit("null_rate", "rise", 0.10), True),
        Check(column, "distinct_values", "distinct", limit=Limit("distinct_count", "factor", 3.0), text=True),
        Check(column, "bad_share", "share", lambda v: ~v.isin(*allowed), present, Limit("pattern", "level", 0.04), True),
        Check(column, "share", "share", lambda v: v == allowed[0], present, Limit("distribution", "shift", 0.15), True),
    ]


#: The four columns of the load check.
TRIP_CHECKS: list[Check] = [*number_checks("base_passenger_fare", True), *number_checks("trip_miles", True), *number_checks("airport_fee", False), *flag_checks("wav_request_flag")]


def value_states(df: DataFrame, by: str, checks: Sequence[Check] = TRIP_CHECKS) -> DataFrame:
    """``by``, ``column_name``, ``num``, ``txt``, ``n``: how often each value of the checked columns occurs in each load. Merges by adding ``n``.

    One scan, unpivoted and partially aggregated per task, so that a load with a
    third of all rows sends one row per distinct value and task. Nulls are
    counted under null in both value columns; NaN is a value.
    """
    columns = {c.column: c.text for c in checks}
    values = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.lit(None).cast("double") if text else F.col(c).cast("double")).alias("num"),
                (F.col(c).cast("string") if text else F.lit(None).cast("string")).alias("txt"),
            )
            for c, text in columns.items()
        ]
    )
    return df.select(F.col(by), F.explode(values).alias("_v")).select(by, "_v.column_name", "_v.num", "_v.txt").groupBy(by, "column_name", "num", "txt").agg(F.count(F.lit(1)).alias("n"))


def merge_value_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of several loads, days or tables as those of ``by`` (none: all together)."""
    return states.groupBy(*by, "column_name", "num", "txt").agg(F.sum("n").alias("n"))


def _compiled(checks: Sequence[Check], part: Callable[[Check], Column | None]) -> Column:
    """A predicate over a state row: for the row's column, what ``part`` of its check says."""
    out = F.lit(False)
    for check in checks:
        when = part(check)
        if when is not None:
            out = F.when(F.col("column_name") == check.column, F.coalesce(when, F.lit(False))).otherwise(out)
    return out


def _value(check: Check) -> Column:
    return F.col("txt") if check.text else F.col("num")


def exact_medians(states: DataFrame, by: str, keep: Column, steps: int = 16) -> DataFrame:
    """``by``, ``column_name``, ``median`` of the numbers that ``keep`` selects, counted ``n`` times each; the mean of the two middle values if even.

    No group is gathered: the counts are first summed per load, column and
    order-preserving bucket (``steps`` to each power of two) and the buckets
    with the two middle ranks are found by running sums over buckets; only their
    values are then ranked, by running sums that spill.
    """
    v = F.col("num")
    octave = lambda x: F.floor(F.log2(x) * steps) + 2000 * steps  # noqa: E731 - above 0 for every double
    bucket = F.when(v > 0, octave(v)).when(v < 0, -octave(-v)).otherwise(0)
    # tied to the count, so that the filter stays above the states' aggregate and all readers share its scan and shuffle
    kept = states.where(F.when(F.col("n") > 0, keep & v.isNotNull() & ~F.isnan(v))).select(by, "column_name", "num", "n", bucket.alias("_b"))
    group = [by, "column_name"]
    counts = kept.groupBy(*group, "_b").agg(F.sum("n").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(Window.partitionBy(*group))
    placed = counts.withColumns({"_upto": upto, "_total": total}).withColumns({"_low": F.floor((F.col("_total") + 1) / 2), "_high": F.floor(F.col("_total") / 2) + 1, "_before": F.col("_upto") - F.col("_n")})
    holds = lambda rank: (F.col("_before") < F.col(rank)) & (F.col(rank) <= F.col("_upto"))
    middle = placed.where(holds("_low") | holds("_high")).select(F.col(by).alias("_by"), F.col("column_name").alias("_c"), F.col("_b").alias("_m"), "_low", "_high", "_before")
    inside = kept.join(middle, F.col(by).eqNullSafe(F.col("_by")) & (F.col("column_name") == F.col("_c")) & F.col("_b").eqNullSafe(F.col("_m"))).drop("_by", "_c", "_m")
    rank = F.col("_before") + F.sum("n").over(Window.partitionBy(*group, "_b").orderBy("num").rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.withColumn("_rank", rank)
    at = lambda r: F.min(F.when(F.col("_rank") >= F.col(r), F.col("num")))
    return ranked.groupBy(*group).agg(((at("_low") + at("_high")) / 2).alias("median"))


def load_figures(states: DataFrame, by: str, checks: Sequence[Check] = TRIP_CHECKS) -> DataFrame:
    """The figures of each load and column from value states: ``rows``, ``nulls`` and one column per declared figure.

    All shares and distinct counts come from one aggregate into which the checks
    are compiled, the medians from :func:`exact_medians` over the same states. A
    share is null where its base is empty, as is a figure that a column doesn't
    declare.
    """
    n = F.col("n")
    named = {c.figure: [x for x in checks if x.figure == c.figure] for c in checks}
    count = lambda when: F.coalesce(F.sum(F.when(when, n)), F.lit(0))
    null = F.col("num").isNull() & F.col("txt").isNull()
    aggregates, out = [F.sum(n).alias("rows"), count(null).alias("nulls")], [F.col(by), F.col("column_name"), F.col("rows"), F.col("nulls")]
    medians = None
    for i, (figure, same) in enumerate(named.items()):
        kind = same[0].kind
        if kind == "share":
            aggregates += [count(_compiled(same, lambda c: c.counted(_value(c)))).alias(f"_c{i}"), count(_compiled(same, lambda c: F.lit(True) if c.base is None else c.base(_value(c)))).alias(f"_d{i}")]
            out.append(F.when(F.col(f"_d{i}") > 0, F.col(f"_c{i}") / F.col(f"_d{i}")).alias(figure))
        elif kind == "distinct":
            aggregates.append(F.count(F.when(_compiled(same, lambda c: _value(c).isNotNull()), 1)).alias(figure))
            out.append(F.col(figure))
        elif kind == "median":
            found = exact_medians(states, by, _compiled(same, lambda c: c.counted(_value(c)))).select(F.col(by).alias("_by"), F.col("column_name").alias("_col"), F.col("median").alias(figure))
            medians = found if medians is None else medians.join(found, ["_by", "_col"], "full")
            out.append(F.col(figure))
        else:
            raise ValueError(f"unknown figure {kind}")
    figures = states.groupBy(by, "column_name").agg(*aggregates)
    if medians is not None:
        figures = figures.join(medians, F.col(by).eqNullSafe(F.col("_by")) & (F.col("column_name") == F.col("_col")), "left")
    return figures.select(*out)


def load_findings(figures: DataFrame, by: str, checks: Sequence[Check] = TRIP_CHECKS) -> DataFrame:
    """``by``, ``column_name``, ``finding``: the loads whose figures break their limits.

    Each figure is compared with its median over all loads of the column, a
    window over a row per load and column whatever the size of the table. A
    figure that is null is no finding.
    """
    limited = [c for c in checks if c.limit]
    centers = {f"_m_{f}": F.percentile(F.col(f).cast("double"), F.lit(0.5)).over(Window.partitionBy("column_name")) for f in dict.fromkeys(c.figure for c in limited)}
    both = figures.withColumns(centers)
    found = [F.when((F.col("column_name") == c.column) & c.limit.broken(F.col(c.figure).cast("double"), F.col(f"_m_{c.figure}")), c.limit.finding) for c in limited]
    return both.select(by, "column_name", F.explode(F.array_distinct(F.array_compact(F.array(*found)))).alias("finding"))


#: Declared patterns of the text columns; a non-null value that doesn't match is malformed.
PATTERNS: dict[str, str] = {
    "hvfhs_license_num": r"^HV[0-9]{4}$",
    "dispatching_base_num": r"^B[0-9]{5}$",
    "originating_base_num": r"^B[0-9]{5}$",
    "shared_request_flag": r"^[YN]$",
    "shared_match_flag": r"^[YN]$",
    "access_a_ride_flag": r"^[YN]$",
    "wav_request_flag": r"^[YN]$",
    "wav_match_flag": r"^[YN]$",
    "trip_id": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    "rider_id": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    "device_id": r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
    "payment_token": r"^[0-9a-f]{16}$",
    "rider_email": r"^[^@\s]+@[^@\s]+\.[A-Za-z]+$",
    "driver_license_num": r"^[0-9]{6,7}$",
    "vehicle_plate": r"^[A-Z]{3}-?[0-9]{4}$|^T[0-9]{6}C$",
    "vehicle_vin": r"^[A-HJ-NPR-Z0-9]{17}$",
}


def profile_states(df: DataFrame, by: Sequence[str], patterns: Mapping[str, str] = PATTERNS, lg_k: int = 11) -> DataFrame:
    """A mergeable profile state per load and column of ``df`` from one shared scan.

    ``rows``, ``nulls``, ``nans``, ``malformed`` (numbers: negative or not
    finite; text: not the declared pattern; times: none), ``min_num``,
    ``max_num``, ``sum_num`` (finite numbers; times as seconds), ``min_txt``,
    ``max_txt`` (text), ``distinct_state`` (HyperLogLog of the values' hashes) and ``quantile_state`` (KLL over
    finite numbers), ``positive`` (finite numbers above 0) and ``yes`` (flags: ``Y``). Array, map and struct columns are counted by their text.

    The columns are aggregated side by side, a row per load and task reaches the
    shuffle, and only the result is turned into a row per column. An empty table
    has no state.
    """
    aggregates, rows = ["count(1) as _rows"], []
    kinds = {"nans": "bigint", "malformed": "bigint", "min_num": "double", "max_num": "double", "sum_num": "double", "min_txt": "string", "max_txt": "string", "distinct_state": "binary", "quantile_state": "binary", "positive": "bigint", "yes": "bigint"}
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    for i, f in enumerate(f for f in df.schema.fields if f.name not in by):
        c = f"`{f.name}`"
        numeric, timed, atomic = isinstance(f.dataType, T.NumericType), isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)), isinstance(f.dataType, T.AtomicType)
        text = f"cast({c} as string)" if atomic else f"to_json(struct({c}))"
        own = {"nulls": f"count_if({c} is null)", "distinct_state": f"hll_sketch_agg(if({c} is null, null, xxhash64({c if atomic else text})), {lg_k})"}
        if numeric or timed:
            number = f"cast({c} as double)" if numeric else f"unix_micros(cast({c} as timestamp)) / 1e6"
            fractional = isinstance(f.dataType, (T.FloatType, T.DoubleType))
            fit = f"if(isnan({number}) or abs({number}) = double('inf'), null, {number})" if fractional else number
            own |= {"min_num": f"min({fit})", "max_num": f"max({fit})", "sum_num": f"sum({fit})", "quantile_state": f"kll_sketch_agg_double({fit})", "positive": f"count_if({fit} > 0)"}
            if numeric:
                own["malformed"] = f"count_if(isnan({number}) or {number} < 0 or {number} = double('inf'))" if fractional else f"count_if({number} < 0)"
            if fractional:
                own["nans"] = f"count_if(isnan({number}))"
        else:
            own |= {"min_txt": f"min({text})", "max_txt": f"max({text})", "yes": f"count_if({text} = 'Y')"}
            if f.name in patterns:
                own["malformed"] = f"count_if(not {c} rlike {quoted(patterns[f.name])})"
        aggregates += [f"{a} as _{i}_{name}" for name, a in own.items()]
        figures = [f"cast({f'_{i}_{name}' if name in own else '0' if kind == 'bigint' else 'null'} as {kind}) as {name}" for name, kind in kinds.items()]
        rows.append(f"struct({quoted(f.name)} as column_name, _rows as rows, _{i}_nulls as nulls, {', '.join(figures)})")
    wide = spread(df).groupBy(*by).agg(*[F.expr(a) for a in aggregates])
    return wide.where("_rows > 0").select(*by, F.expr(f"inline(array({', '.join(rows)}))"))


def merge_profile_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profile states of several loads as those of ``by``."""
    add = lambda c: F.sum(c).alias(c)
    return states.groupBy(*by, "column_name").agg(
        *[add(c) for c in ("rows", "nulls", "nans", "malformed")], F.min("min_num").alias("min_num"), F.max("max_num").alias("max_num"), add("sum_num"),
        F.min("min_txt").alias("min_txt"), F.max("max_txt").alias("max_txt"), F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"), add("positive"), add("yes"),
    )


def read_profile(states: DataFrame) -> DataFrame:
    """Profile states as figures: rates, approximate distinct count (about 2 % error), range, quartiles (about 1 % rank error)."""
    some = F.kll_sketch_get_n_double("quantile_state") > 0
    quantile = lambda q, name: F.when(some, F.kll_sketch_get_quantile_double("quantile_state", F.lit(q))).alias(name)
    keys = [c for c in states.columns if c in states.columns[: states.columns.index("column_name")]]
    return states.select(
        *keys, "column_name", "rows", "nulls", (F.col("nulls") / F.col("rows")).alias("null_rate"), "nans", "malformed",
        F.hll_sketch_estimate("distinct_state").alias("approx_distinct"), "min_num", "max_num", "min_txt", "max_txt",
        quantile(0.25, "p25"), quantile(0.5, "p50"), quantile(0.75, "p75"),
    )


#: Numbers that count on from load to load, as times do: their place is no finding, their spread may be.
SERIAL = ("record_id",)


def profile_findings(states: DataFrame, by: str, serial: Sequence[str], null_rise: float = 0.10, distinct_factor: float = 3.0, bad_share: float = 0.04, quartile_factor: float = 1.5, share_shift: float = 0.15) -> DataFrame:
    """``by``, ``column_name``, ``finding``: the loads whose profile leaves the control limits, for every column of the profile states.

    Each figure is compared with its median over all loads: ``null_rate``,
    ``distinct_count`` (estimated), ``malformed`` (share of non-null values) and
    ``distribution`` (a quartile where it and its median are positive, the share
    of values above 0, or of ``Y``; of a column in ``serial`` only the quartiles'
    distance). How the values of other text spread is not compared. The medians
    are windows over a row per load and column, so the states are made once.
    """
    in_serial = F.col("column_name").isin(*serial)
    values, numbers = F.col("rows") - F.col("nulls"), F.kll_sketch_get_n_double("quantile_state")
    quantile = lambda q: F.when(numbers > 0, F.kll_sketch_get_quantile_double("quantile_state", F.lit(q)))
    ratio = lambda a, b: F.when(b > 0, a / b)
    figures = states.select(
        by, "column_name", ratio(F.col("nulls"), F.col("rows")).alias("null_rate"), F.hll_sketch_estimate("distinct_state").cast("double").alias("distinct"),
        ratio(F.col("malformed"), values).alias("malformed"), *[F.when(~in_serial, quantile(q)).alias(n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))],
        F.when(in_serial, quantile(0.75) - quantile(0.25)).alias("spread"),
        F.when(~in_serial, F.coalesce(ratio(F.col("positive"), numbers), F.when(F.col("max_txt").isin("Y", "N") | (F.col("yes") > 0), ratio(F.col("yes"), values)))).alias("share"),
    )
    names = figures.columns[2:]
    both = figures.withColumns({f"m_{c}": F.percentile(c, F.lit(0.5)).over(Window.partitionBy("column_name")) for c in names})
    outside = lambda c, factor: (F.col(f"m_{c}") > 0) & ((F.col(c) >= factor * F.col(f"m_{c}")) | (F.col(c) * factor <= F.col(f"m_{c}")))
    moved = F.abs(F.col("share") - F.col("m_share")) >= share_shift
    for c in ("p25", "p50", "p75", "spread"):
        moved = F.coalesce(moved, F.lit(False)) | F.coalesce((F.col(c) > 0) & outside(c, quartile_factor), F.lit(False))
    appears = (F.col("distinct") > 0) & (F.col("m_distinct") == 0)
    found = F.array(
        F.when(F.col("null_rate") >= F.col("m_null_rate") + null_rise, "null_rate"),
        F.when(outside("distinct", distinct_factor) | appears, "distinct_count"),
        F.when(F.col("malformed") >= F.col("m_malformed") + bad_share, "malformed"),
        F.when(moved, "distribution"),
    )
    return both.select(by, "column_name", F.explode(F.array_compact(found)).alias("finding"))
