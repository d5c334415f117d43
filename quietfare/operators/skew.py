"""Per-key results when a handful of keys hold most rows.

Everything here rests on *eager aggregation*: each input is reduced to one
compact state per key before anything is joined (the partial aggregate runs
beside the scan, so a hot key arrives at the shuffle as one row per task), the
states are joined, and counts and sums are combined algebraically:

    rows of L join R with key k   = n_L(k) * n_R(k)
    sum of an L column over them  = s_L(k) * n_R(k)
    sum of an R column over them  = s_R(k) * n_L(k)

Ranks inside a key need the rows themselves; they are range-partitioned over
key *and* order columns, so a hot key is spread over as many tasks as its rows
need, and only one offset per task is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietfare.session import cut


def finite(column: Column) -> Column:
    """``column`` where it is a finite number, else null."""
    value = column.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def key_states(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """One compact, mergeable state per key: row count, and for each of ``sums`` the sum of its finite values.

    Null keys form a state of their own. A sum over no finite value is 0.0. An
    empty input gives no state.
    """
    aggs = [F.count(F.lit(1)).alias(f"{prefix}rows")]
    aggs += [F.coalesce(F.sum(finite(F.col(c))), F.lit(0.0)).alias(f"{prefix}sum_{c}") for c in sums]
    return df.groupBy(*keys).agg(*aggs)


def unpivot_keys(df: DataFrame, fields: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """A row per input row and field: ``field``, ``key`` and the columns to sum. One scan serves all fields."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("key")) for f in fields])
    return df.select(F.explode(pairs).alias("_p"), *[F.col(c) for c in sums]).select("_p.field", "_p.key", *sums)


def merge_key_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rolls states up to ``keys``: every other numeric column is added."""
    rest = [c for c in states.columns if c not in keys and (c.endswith("rows") or "sum_" in c)]
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_sums: Sequence[str] = (),
    right_sums: Sequence[str] = (),
    left_by: Sequence[str] = (),
    right_by: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Counts and sums of ``left JOIN right USING (on)`` per key and ``left_by``/``right_by``, without making the join's rows.

    Both sides are reduced to states first. The result has the keys, the group
    columns, ``rows`` (of the join), ``sum_<c>`` for each named column. ``how``
    is inner or left; an unmatched left state counts once. Null keys match
    nothing, as in SQL. Columns of the same name on both sides don't clash: the
    group columns must differ, sums of the right are prefixed on request by the
    caller's renaming.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if set(left_by) & set(right_by) or set(left_sums) & set(right_sums):
        raise ValueError("group and sum columns of both sides must have different names")
    a = key_states(left, [*on, *left_by], left_sums, "_l_")
    b = key_states(right, [*on, *right_by], right_sums, "_r_")
    joined = a.join(b, list(on), how)
    n_left, n_right = F.col("_l_rows"), F.coalesce(F.col("_r_rows"), F.lit(1))
    return joined.select(
        *on, *left_by, *right_by,
        (n_left * n_right).alias("rows"),
        *[(F.col(f"_l_sum_{c}") * n_right).alias(f"sum_{c}") for c in left_sums],
        *[(F.coalesce(F.col(f"_r_sum_{c}"), F.lit(0.0)) * n_left).alias(f"sum_{c}") for c in right_sums],
    )


def heavy_keys(df: DataFrame, fields: Sequence[str], dimension: DataFrame, percent: int = 3) -> DataFrame:
    """``field``, ``key``, ``rows``, ``total``: the non-null keys with at least ``percent`` % of all rows.

    ``dimension`` has the known keys in its first column. It and ``df`` are
    pre-aggregated by key and their states joined (:func:`eager_join_aggregate`);
    the counts are rolled up per key and per field and compared in whole numbers,
    so no rounding decides. Keys that the dimension doesn't know, or knows more
    than once, count like any other. Rows with a null key count in the total. An
    empty table has no heavy key.
    """
    known = dimension.select(F.col(dimension.columns[0]).alias("key")).distinct()
    joined = eager_join_aggregate(unpivot_keys(df, fields), known, ["key"], left_by=["field"], how="left")
    per_field = merge_key_states(joined, ["field"]).withColumnRenamed("rows", "total")
    # tied to the count, so that the filter stays above the aggregate and both sides share one scan and shuffle
    some_key = F.when(F.col("rows") > 0, F.col("key")).isNotNull()
    return (
        joined.where(some_key)
        .join(per_field, "field")
        .where(F.col("rows") * 100 >= F.col("total") * percent)
        .select("field", "key", "rows", "total")
    )


def rank_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] = (), name: str = "rank_in_key", partitions: int | None = None) -> DataFrame:
    """Each row's 1-based rank among the rows of its key, by ``order`` (ascending, nulls first).

    ``order`` should end in a unique column; rows that tie on all of it get
    different ranks in an unspecified order. Null keys rank among themselves.

    One range shuffle over (keys, order) spreads a hot key over many tasks. A
    row's place in its sorted task is kept by a reliable checkpoint (range
    bounds are sampled, so a second run could cut elsewhere); per task and key
    only the first place and the row count are gathered, prefix sums of those
    counts give the offsets.
    """
    columns = list(dict.fromkeys([*keys, *order, *keep]))
    by = [F.col(c) for c in [*keys, *order]]
    ranged = df.select(*columns)
    ranged = (ranged.repartitionByRange(partitions, *by) if partitions else ranged.repartitionByRange(*by)).sortWithinPartitions(*by)
    placed = cut(ranged.select(*dict.fromkeys([*keys, *keep]), F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_place")))
    states = placed.groupBy("_task", *keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = states.select(
        F.col("_task").alias("_t"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_task") == F.col("_t")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(offsets, same).select(*dict.fromkeys([*keys, *keep]), (F.col("_place") + F.col("_shift") + 1).alias(name))
