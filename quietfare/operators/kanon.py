"""Equivalence classes, uniqueness and k-anonymity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classes(df: DataFrame, qi: Sequence[str]) -> DataFrame:
    """``qi`` and ``sz``: the equivalence classes; nulls form classes of their own."""
    return df.groupBy(*qi).agg(F.count(F.lit(1)).alias("sz"))


def _figures(k: int) -> list[Column]:
    sz = F.col("sz")
    rows = F.coalesce(F.sum(sz), F.lit(0))
    share = lambda part: F.round(F.coalesce(F.sum(F.when(part, sz)) / F.nullif(F.sum(sz), F.lit(0)), F.lit(0.0)), 4)
    return [
        rows.alias("rows_in"), F.count(sz).alias("classes"), F.coalesce(F.sum(F.when(sz == 1, sz)), F.lit(0)).alias("unique_rows"), share(sz == 1).alias("uniqueness"),
        F.coalesce(F.sum(F.when(sz >= k, sz)), F.lit(0)).alias("rows_out"), F.count_if(sz < k).alias("cells_suppressed"), share(sz < k).alias("suppressed"), F.min(F.when(sz >= k, sz)).alias("k_achieved"),
    ]


def risk(df: DataFrame, qi: Sequence[str], k: int = 5) -> DataFrame:
    """One row: rows, classes, uniqueness (share of rows alone in their class) and the cost of k-suppression. Empty: 0 and null."""
    return classes(df, qi).agg(*_figures(k))


def ladder(df: DataFrame, rungs: Mapping[str, Sequence[str]], k: int = 5) -> DataFrame:
    """The risk figures of every rung from one scan.

    A single GROUPING SETS aggregate (one Expand, partial aggregates beside the
    scan) replaces a scan per rung; ``qi`` names the rung.
    """
    names = list(dict.fromkeys(c for qi in rungs.values() for c in qi))
    sets = [[F.col(c) for c in qi] for qi in rungs.values()]
    cells = df.groupingSets(sets, *names).agg(F.count(F.lit(1)).alias("sz"), F.grouping_id().alias("_g"))
    bit = {c: 1 << (len(names) - 1 - i) for i, c in enumerate(names)}
    rung = F.lit(None).cast("string")
    for label, qi in rungs.items():
        rung = F.when(F.col("_g") == sum(bit[c] for c in names if c not in qi), F.lit(label)).otherwise(rung)
    return cells.groupBy(rung.alias("qi")).agg(*_figures(k))


def _same(qi: Sequence[str]) -> Column:
    out = F.lit(True)
    for i, c in enumerate(qi):
        out &= F.col(c).eqNullSafe(F.col(f"_q{i}"))
    return out


def _sizes(df: DataFrame, qi: Sequence[str], name: str) -> DataFrame:
    return classes(df, qi).select(*[F.col(c).alias(f"_q{i}") for i, c in enumerate(qi)], F.col("sz").alias(name))


def suppress(df: DataFrame, qi: Sequence[str], k: int = 5) -> DataFrame:
    """The rows whose class has at least ``k`` rows.

    The class sizes are counted first (partial aggregates) and joined back
    null-safely: a hot class is never gathered in one task, as it would be in a
    window over the class, and adaptive execution splits it in the join.
    """
    return df.join(_sizes(df, qi, "_sz").where(F.col("_sz") >= k), _same(qi), "left_semi")


def suppression_audit(df: DataFrame, qi: Sequence[str], k: int = 5) -> DataFrame:
    """One row beside :func:`suppress`: ``qi``, ``k``, ``rows_in``, ``rows_out``, ``cells_suppressed`` (rows taken away) and ``k_achieved`` (null if nothing is left)."""
    kept = F.sum(F.when(F.col("sz") >= k, F.col("sz")))
    rows_in, rows_out = F.coalesce(F.sum("sz"), F.lit(0)), F.coalesce(kept, F.lit(0))
    figures = classes(df, qi).agg(rows_in.alias("rows_in"), rows_out.alias("rows_out"), (rows_in - rows_out).alias("cells_suppressed"), F.min(F.when(F.col("sz") >= k, F.col("sz"))).alias("k_achieved"))
    return figures.select(F.array(*[F.lit(c) for c in qi]).alias("qi"), F.lit(k).alias("k"), "*")


#: Names by which a quasi-identifier is chosen, and their columns of the risk input.
QI_TOKENS = {"PULocationID": "pu", "DOLocationID": "do_id", "pickup_bucket": "quarter", "PUBorough": "pb", "DOBorough": "db"}


def qi_columns(tokens: Sequence[str]) -> list[str]:
    """The risk input's columns of a chosen quasi-identifier; an unknown token is an error that names the known ones."""
    unknown = [t for t in tokens if t not in QI_TOKENS]
    if unknown or not tokens:
        raise ValueError(f"unknown quasi-identifier {', '.join(unknown) or '(none given)'}; choose from {', '.join(QI_TOKENS)}")
    return [QI_TOKENS[t] for t in tokens]


def class_size(df: DataFrame, qi: Sequence[str], name: str = "class_size") -> DataFrame:
    """``df`` with the size of each row's class, joined back like in :func:`suppress`. A column ``name`` is replaced."""
    base = df.drop(name)
    return base.join(_sizes(base, qi, name), _same(qi)).select(*base.columns, name)


def size_histogram(df: DataFrame, qi: Sequence[str]) -> DataFrame:
    """How many classes there are of each size."""
    return classes(df, qi).groupBy("sz").agg(F.count(F.lit(1)).alias("n_classes"), F.sum("sz").alias("n_rows"))


def cells(df: DataFrame, dimensions: Sequence[str], k: int = 5) -> DataFrame:
    """Counts per cell of ``dimensions``, without the cells below ``k``."""
    return df.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("trip_count")).where(F.col("trip_count") >= k)


def cells_audit(df: DataFrame, dimensions: Sequence[str], k: int = 5) -> DataFrame:
    """One row: cells in and out, suppressed cells, rows represented, smallest published count."""
    all_cells = df.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("n"))
    kept = F.col("n") >= k
    return all_cells.agg(
        F.count(F.lit(1)).alias("cells_in"), F.count_if(kept).alias("cells_out"), F.count_if(~kept).alias("cells_suppressed"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("rows_represented"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.min(F.when(kept, F.col("n"))).alias("k_achieved"),
    )
