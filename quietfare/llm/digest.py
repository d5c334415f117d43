"""Percentiles of very large numeric columns with deterministic rank error (q-digest).

Values are quantised to a bounded ordered universe of ``2**LEVELS`` leaves: sign,
128 powers of two and 14 bits below the leading one, so a leaf is narrower than
``2**-14`` of its value. A digest is a set of counted nodes of the dyadic tree
over the leaves (heap numbering, root 1). Compression keeps, for ``n`` values and
the factor ``k``, only nodes with

    count(node) + count(sibling) + count(parent) > floor(n / k)

and moves the others into their parents; the rank error of any quantile is at
most ``LEVELS * n / k = error * n``. Digests merge by adding the counts of equal
nodes and compressing again, so loads, days or partitions are digested once and
combined in any grouping. Below ``k`` values nothing is moved and the digest is
exact on the quantised values.

Leaves are worked out inside the JVM. Every task digests its own rows before
anything is shuffled, all groups of some hundred thousand rows at once, so a group
with a third of all rows reaches the shuffle as one digest per task, however many
rows there are. Equal nodes of the tasks' digests are then added by an ordinary
aggregate, spread by group and node, and the sums of each group are compressed
as they stream by, sorted by group, in memory bounded by a digest's size.

A state carries its ``error``; what is merged from several has the greatest.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANTISSA_BITS = 14
EXPONENT_LOW, EXPONENT_COUNT = -32, 128
#: Tree height: one bit of sign, seven of exponent, the mantissa.
LEVELS = 1 + 7 + MANTISSA_BITS
HALF = EXPONENT_COUNT << MANTISSA_BITS
#: Widest relative distance between a value and the value reported for its leaf.
VALUE_ERROR = 2.0**-MANTISSA_BITS

STATE = "n bigint, error double, digest array<struct<node:bigint,count:bigint>>"
#: Rows or nodes that a task holds before it digests them; it hands on what doesn't shrink to half of them.
HELD = 1 << 19


def leaf_sql(value: str) -> str:
    """SQL of the leaf of a double column, in Spark's and DuckDB's common dialect.

    Truncates towards zero; magnitudes under ``2**-32`` go to zero's leaf, those
    from ``2**96`` on, and infinities, to the outermost leaves. Null and NaN have
    no leaf.
    """
    a = f"abs({value})"
    e0 = f"floor(log2({a}))"
    e = f"(CASE WHEN {a} < power(2.0, {e0}) THEN {e0} - 1 WHEN {a} >= power(2.0, {e0} + 1) THEN {e0} + 1 ELSE {e0} END)"
    m = f"(({e} - {EXPONENT_LOW}) * {1 << MANTISSA_BITS} + floor({a} / power(2.0, {e}) * {1 << MANTISSA_BITS}) - {1 << MANTISSA_BITS})"
    low, high = f"CAST({2.0**EXPONENT_LOW!r} AS DOUBLE)", f"CAST({2.0 ** (EXPONENT_LOW + EXPONENT_COUNT)!r} AS DOUBLE)"
    magnitude = f"(CASE WHEN {a} < {low} THEN 0 WHEN {a} >= {high} THEN {HALF - 1} ELSE CAST({m} AS BIGINT) END)"
    return f"CASE WHEN {value} IS NULL OR isnan({value}) THEN NULL WHEN {value} >= 0 OR {magnitude} = 0 THEN {HALF} + {magnitude} ELSE {HALF - 1} - {magnitude} END"


def with_leaf(df: DataFrame) -> DataFrame:
    """``df`` with ``_leaf``, the leaf of its column ``value`` as in :func:`leaf_sql`, each power and logarithm worked out once."""
    low, high = 2.0**EXPONENT_LOW, 2.0 ** (EXPONENT_LOW + EXPONENT_COUNT)
    steps = df.withColumn("_a", F.abs("value")).withColumn("_e", F.floor(F.log2(F.when((F.col("_a") >= low) & (F.col("_a") < high), F.col("_a"))))).withColumn("_m", F.col("_a") / F.pow(F.lit(2.0), F.col("_e")))
    # the logarithm may be off by one beside a power of two: the mantissa must lie in [1, 2)
    steps = steps.withColumn("_s", F.when(F.col("_m") < 1, -1).when(F.col("_m") >= 2, 1).otherwise(0))
    mantissa = F.when(F.col("_s") < 0, F.col("_m") * 2).when(F.col("_s") > 0, F.col("_m") / 2).otherwise(F.col("_m"))
    inner = (F.col("_e") + F.col("_s") - EXPONENT_LOW) * (1 << MANTISSA_BITS) + F.floor((mantissa - 1) * (1 << MANTISSA_BITS))
    steps = steps.withColumn("_g", F.when(F.col("_a") < low, F.lit(0)).when(F.col("_a") >= high, F.lit(HALF - 1)).otherwise(inner).cast("bigint"))
    return steps.withColumn("_leaf", F.when((F.col("value") >= 0) | (F.col("_g") == 0), F.col("_g") + HALF).otherwise(F.lit(HALF - 1) - F.col("_g"))).drop("_a", "_e", "_m", "_s", "_g")


def leaf_value(leaf: np.ndarray) -> np.ndarray:
    """The value reported for leaves: the end of each nearest to zero; infinite for the outermost."""
    leaf = leaf.astype(np.int64)
    positive = leaf >= HALF
    magnitude = np.where(positive, leaf - HALF, HALF - 1 - leaf)
    exponent = (magnitude >> MANTISSA_BITS) + EXPONENT_LOW
    value = np.ldexp(1.0 + (magnitude & ((1 << MANTISSA_BITS) - 1)) / float(1 << MANTISSA_BITS), exponent.astype(np.int32))
    value = np.where(magnitude == 0, 0.0, np.where(magnitude == HALF - 1, np.inf, value))
    return np.where(positive, value, -value)


def compress(group: np.ndarray, node: np.ndarray, count: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compresses the digests of many groups at once, level by level from the leaves.

    ``threshold`` has floor(n / k) per group. A group of threshold 0 stays as it is.
    """
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    lossless = threshold[group] == 0
    kept.append((group[lossless], node[lossless], count[lossless]))
    group, node, count = group[~lossless], node[~lossless], count[~lossless]
    depth = np.frexp(node.astype(np.float64))[1] - 1
    level = {d: depth == d for d in np.unique(depth)}
    g, v, c = (x[:0] for x in (group, node, count))
    for d in range(LEVELS, 0, -1):
        here = level.get(d)
        if here is not None:
            g, v, c = np.concatenate([g, group[here]]), np.concatenate([v, node[here]]), np.concatenate([c, count[here]])
        if not len(g):
            continue
        order = np.lexsort((v, g))
        g, v, c = g[order], v[order], c[order]
        first = np.r_[True, (g[1:] != g[:-1]) | (v[1:] != v[:-1])]
        start = np.flatnonzero(first)
        g, v, c = g[start], v[start], np.add.reduceat(c, start)
        # pairs of siblings, with the parent's count where it has one already
        parent = v >> 1
        pair = np.r_[True, (g[1:] != g[:-1]) | (parent[1:] != parent[:-1])]
        at = np.flatnonzero(pair)
        of_pair = np.cumsum(pair) - 1
        total = np.add.reduceat(c, at)
        pg, pv = g[at], parent[at]
        above = level.get(d - 1)
        if above is not None and above.any():
            ug, uv, uc = group[above], node[above], count[above]
            key = pg.astype(np.int64) * (1 << (LEVELS + 1)) + pv
            known = ug.astype(np.int64) * (1 << (LEVELS + 1)) + uv
            by = np.argsort(known, kind="stable")
            place = np.minimum(np.searchsorted(known[by], key), len(known) - 1)
            total = total + np.where(known[by][place] == key, uc[by][place], 0)
        stays = (total > threshold[pg])[of_pair]
        kept.append((g[stays], v[stays], c[stays]))
        g, v, c = g[~stays], parent[~stays], c[~stays]
    if 0 in level:
        g, v, c = np.concatenate([g, group[level[0]]]), np.concatenate([v, node[level[0]]]), np.concatenate([c, count[level[0]]])
    if len(g):  # the root takes what is left
        order = np.argsort(g, kind="stable")
        g, c = g[order], c[order]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        kept.append((g[start], np.ones(len(start), np.int64), np.add.reduceat(c, start)))
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def _right_end(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    depth = np.frexp(node.astype(np.float64))[1] - 1
    up = LEVELS - depth
    return ((node + 1) << up) - 1 - (1 << LEVELS), up


def _unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(batch.schema.get_field_index("digest"))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), flat.field("node").to_numpy(), flat.field("count").to_numpy()


def _codes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """A number per row that is the same for rows of equal keys; nulls are equal."""
    code = np.zeros(table.num_rows, np.int64)
    for key in keys:
        column = table.column(key).combine_chunks()
        values = (column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column).dictionary_encode("encode")
        _, code = np.unique(code * (len(values.dictionary) + 1) + values.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    return code


def _shrunk(table: pa.Table, keys: Sequence[str], k: int | None = None) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The digests of a table of nodes (keys, node, count and, without ``k``, error): the groups' first rows, and the nodes as arrays of group, node, count."""
    group = _codes(table, keys)
    node, count = (table.column(c).to_numpy() for c in ("node", "count"))
    order = np.lexsort((node, group))
    group, node, count = group[order], node[order], count[order]
    start = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (node[1:] != node[:-1])])
    total = np.add.reduceat(count, start)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    n = np.add.reduceat(count, first)
    if k is None:
        error = np.maximum.reduceat(table.column("error").to_numpy()[order], first)
        head = table.select(keys).take(pa.array(order[first])).append_column("n", pa.array(n)).append_column("error", pa.array(error))
        threshold = n // np.ceil(LEVELS / error).astype(np.int64)
    else:
        head, threshold = table.select(keys).take(pa.array(order[first])), n // k
    return head, *compress(group[start], node[start], total, threshold)


def _nodes_of(head: pa.Table, keys: Sequence[str], group: np.ndarray, node: np.ndarray, count: np.ndarray) -> pa.Table:
    return head.select(keys).take(pa.array(group)).append_column("node", pa.array(node)).append_column("count", pa.array(count))


def _task_digests(keys: Sequence[str], k: int, held: int):
    """Rows (keys, node) as the nodes (keys, node, count) of a digest per group; a group may come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def digested() -> pa.Table:
            return _nodes_of(*((x := _shrunk(pa.concat_tables(waiting), keys, k))[0], keys, *x[1:]))

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                waiting.append(table.append_column("count", pa.array(np.ones(table.num_rows, np.int64))))
                size += table.num_rows
            if size >= held:
                waiting = [digested()]
                size = waiting[0].num_rows
                if size > held // 2:
                    yield from waiting[0].combine_chunks().to_batches(1 << 16)
                    waiting, size = [], 0
        if waiting:
            yield from digested().combine_chunks().to_batches(1 << 16)

    return run


def _group_digests(keys: Sequence[str], held: int):
    """Nodes (keys, node, count, error), sorted by keys, as one digest per group."""

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        head, group, node, count = _shrunk(table, keys)
        right, up = _right_end(node)
        order = np.lexsort((up, right, group))  # the order in which a quantile passes the nodes
        group, node, count = group[order], node[order], count[order]
        offsets = np.r_[0, np.cumsum(np.bincount(group, minlength=head.num_rows))].astype(np.int32)
        nodes = pa.StructArray.from_arrays([pa.array(node, pa.int64()), pa.array(count, pa.int64())], ["node", "count"])
        out = head.append_column("digest", pa.ListArray.from_arrays(pa.array(offsets), nodes))
        yield from out.combine_chunks().to_batches(1 << 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(pa.Table.from_batches([batch]))
                size += batch.num_rows
            if size < held:
                continue
            table = pa.concat_tables(waiting).combine_chunks()
            code = _codes(table, keys)
            last = table.num_rows - int(np.argmax((code != code[-1])[::-1])) if (code != code[-1]).any() else 0
            if last:  # all groups but the last are complete
                yield from rows(table.slice(0, last))
                table = table.slice(last)
            if table.num_rows > held // 2:  # a group of many tasks: what is there of it can be compressed already
                head, group, node, count = _shrunk(table, keys)
                table = _nodes_of(head, keys, group, node, count).append_column("error", head.column("error").take(pa.array(group)))
            waiting, size = [table], table.num_rows
        if waiting:
            yield from rows(pa.concat_tables(waiting))

    return run


def _schema_text(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _digest(nodes: DataFrame, keys: Sequence[str], held: int) -> DataFrame:
    """``nodes`` (keys, node, count, error) as one compressed digest per group of keys: equal nodes are added first, spread by group and node."""
    counted = nodes.groupBy(*keys, "node").agg(F.sum("count").alias("count"), F.max("error").alias("error"))
    sorted_nodes = counted.repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys)
    return sorted_nodes.mapInArrow(_group_digests(list(keys), held), f"{_schema_text(nodes, keys)}, {STATE}")


def digests(df: DataFrame, by: Sequence[str], columns: Sequence[str], error: float = 0.005, held: int = HELD) -> DataFrame:
    """A digest per group and column: ``by``, ``column_name``, ``n``, ``error``, ``digest``.

    ``error`` bounds the rank error as a share of ``n``. Nulls and NaN are left
    out, infinities are the outermost values; a group without values has no row.
    Null keys form a group, no keys one of all rows. Other columns of ``df`` are
    ignored, whatever their names; ``by`` must not use the result's own names.
    ``held`` bounds what a task keeps in memory, it changes no bound.
    """
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    if {"column_name", "n", "error", "digest"} & set(by):
        raise ValueError("column_name, n, error and digest are names of the result")
    keys = [f"_b{i}" for i in range(len(by))]
    values = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    long = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.explode(values).alias("_v")).select(*keys, "_v._c", "_v.value")
    leaves = with_leaf(long.where("value is not null and not isnan(value)")).select(*keys, "_c", (F.col("_leaf") + F.lit(1 << LEVELS)).alias("node"))
    inner = [*keys, "_c"]
    k = int(np.ceil(LEVELS / error))
    nodes = leaves.mapInArrow(_task_digests(inner, k, held), f"{_schema_text(leaves, inner)}, node bigint, count bigint")
    states = _digest(nodes.withColumn("error", F.lit(error)), inner, held)
    name: Column = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_c") + 1)
    return states.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], name.alias("column_name"), "n", "error", "digest")


def merge_digests(states: DataFrame, by: Sequence[str], held: int = HELD) -> DataFrame:
    """Digests of several groups as those of the coarser ``by``: equal nodes are added, then compressed. The greatest error of a group's states holds for it."""
    nodes = states.select(*by, "column_name", "error", F.explode("digest").alias("_n")).select(*by, "column_name", "_n.node", "_n.count", "error")
    return _digest(nodes, [*by, "column_name"], held)


def read_quantiles(states: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """``states`` without their digests, with one double column per quantile and ``rank_error``.

    The value of quantile q is the leaf at rank ``ceil(q * n)``. ``rank_error`` is
    the state's bound in ranks, 0 where the digest was never compressed; the value itself
    is exact within a relative ``VALUE_ERROR``.
    """
    keys = [c for c in states.columns if c not in ("n", "error", "digest")]
    wanted = dict(quantiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            group, node, count = _unpack(batch)
            right, _ = _right_end(node)
            n = batch.column(batch.schema.get_field_index("n")).to_numpy()
            total = np.cumsum(count)
            base = np.r_[0, np.cumsum(n)[:-1]]
            out = [batch.column(batch.schema.get_field_index(c)) for c in keys]
            out.append(pa.array(n))
            for q in wanted.values():
                rank = np.maximum(1, np.ceil(np.round(q * n, 9))).astype(np.int64)
                out.append(pa.array(leaf_value(right[np.searchsorted(total, base + rank)])))
            exact = np.ones(batch.num_rows, bool)
            exact[group[node < (1 << LEVELS)]] = False
            error = batch.column(batch.schema.get_field_index("error")).to_numpy()
            out.append(pa.array(np.where(exact, 0, np.floor(error * n)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(out, names=[*keys, "n", *wanted, "rank_error"])

    return states.mapInArrow(run, f"{_schema_text(states, keys)}, n bigint, {', '.join(f'{q} double' for q in wanted)}, rank_error bigint")
