import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quietfare.llm import digest as D

Q = {"p50": 0.5, "p99": 0.99}


def leaves(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value double")
    return [r[0] for r in df.selectExpr(D.leaf_sql("value")).collect()]


def test_leaves_keep_the_order_and_the_value(spark):
    random.seed(1)
    values = sorted([0.0, -0.0, 1.0, 2.0, 0.5, 4096.0, 1e-12, -1e-12, 1e40, -1e40, float("inf"), float("-inf"), *[random.choice([-1, 1]) * math.exp(random.uniform(-15, 15)) for _ in range(500)]])
    got = leaves(spark, values)
    assert got == sorted(got)
    back = D.leaf_value(np.array(got))
    for v, b in zip(values, back, strict=True):
        if abs(v) < 2.0**-32:
            assert b == 0
        elif abs(v) < 2.0**96:
            assert abs(b - v) <= abs(v) * D.VALUE_ERROR and abs(b) <= abs(v)
        else:
            assert b == math.copysign(math.inf, v)
    assert leaves(spark, [None, float("nan")]) == [None, None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=400), st.integers(2, 60))
def test_compression_keeps_counts_and_the_rank_bound(values, k):
    node, count = np.unique(np.array(values) * 7919 + (1 << D.LEVELS), return_counts=True)
    n = len(values)
    g, v, c = D.compress(np.zeros(len(node), np.int64), node, count, np.array([n // k]))
    assert c.sum() == n and (g == 0).all() and len(np.unique(v)) == len(v)
    right, up = D._right_end(v)
    order = np.lexsort((up, right))
    total, right = np.cumsum(c[order]), right[order]
    exact = np.sort(np.array(values) * 7919)
    for q in (0.1, 0.5, 0.9, 1.0):
        rank = max(1, math.ceil(q * n))
        got = right[np.searchsorted(total, rank)]
        low, high = np.searchsorted(exact, got, "left") + 1, np.searchsorted(exact, got, "right")
        assert low - rank <= D.LEVELS * n / k and rank - high <= D.LEVELS * n / k


def exact(values, q):
    return sorted(values)[max(1, math.ceil(round(q * len(values), 9))) - 1]


def test_small_groups_are_exact(spark):
    rows = [(g, float(i)) for g in (1, 2, None) for i in range(100)] + [(1, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r for r in D.read_quantiles(D.digests(df, ["g"], ["v"]), Q).collect()}
    assert set(got) == {1, 2, None} and all((r.n, r.p50, r.p99, r.rank_error) == (100, 49.0, 98.0, 0) for r in got.values())


def test_large_groups_keep_the_bound_also_when_merged(spark):
    random.seed(5)
    rows = [(i % 4, random.lognormvariate(3, 1)) for i in range(40000)]
    df = spark.createDataFrame(rows, "day int, v double")
    states = D.digests(df, ["day"], ["v"], 0.01)
    values = np.sort([v for _, v in rows])
    for states_of_all in (D.merge_digests(states, []), D.digests(df, [], ["v"], 0.01), D.digests(df, [], ["v"], 0.01, held=3000), D.merge_digests(D.digests(df, ["day"], ["v"], 0.01, held=500), [], held=500)):
        r = D.read_quantiles(states_of_all, Q).first()
        assert r.n == 40000 and r.rank_error == 400
        for name, q in Q.items():
            rank = np.searchsorted(values, r[name] * (1 + D.VALUE_ERROR))
            assert abs(rank - q * 40000) <= 400 + 1
        assert states_of_all.selectExpr("size(digest) as s").first().s <= 3 * D.LEVELS / 0.01


def test_a_merged_state_has_the_greatest_error(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20000)], "v double")
    both = D.digests(df, [], ["v"], 0.01).union(D.digests(df, [], ["v"], 0.05))
    r = D.read_quantiles(D.merge_digests(both, []), Q).first()
    assert r.n == 40000 and r.rank_error == 2000 and abs(r.p50 - 10000) <= 1000


def test_a_task_hands_on_a_bounded_digest(spark):
    import pyarrow as pa

    node = np.random.default_rng(1).integers(0, 1 << D.LEVELS, 300_000) + (1 << D.LEVELS)
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(10_000, np.int32)), pa.array(node[i : i + 10_000])], names=["g", "node"]) for i in range(0, 300_000, 10_000)]
    k = int(D.LEVELS / 0.05)
    out = pa.Table.from_batches(list(D._task_digests(["g"], k, 50_000)(iter(batches))))
    assert out.num_rows <= 3 * k and sum(out.column("count").to_pylist()) == 300_000


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 50)), min_size=1, max_size=200), st.integers(1, 40), st.integers(1, 64))
def test_streamed_groups_equal_groups_at_once(rows, size, held):
    import pyarrow as pa

    rows = sorted(rows, key=lambda r: (r[0] or "", r[1]))
    table = pa.table({"g": pa.array([r[0] for r in rows]), "node": pa.array([r[1] + (1 << D.LEVELS) for r in rows]), "count": pa.array([1] * len(rows)), "error": pa.array([0.0001] * len(rows))})
    got = [r for b in D._group_digests(["g"], held)(iter(table.to_batches(size))) for r in b.to_pylist()]
    assert sorted((r["g"] or "", r["n"], sum(x["count"] for x in r["digest"])) for r in got) == sorted((g or "", n, n) for g, n in __import__("collections").Counter(r[0] for r in rows).items())


def test_empty_clashing_and_wrong(spark):
    df = spark.createDataFrame([], "day int, value string, column_name int, v double")
    assert D.read_quantiles(D.digests(df, ["day"], ["v"]), Q).count() == 0
    full = spark.createDataFrame([(1, "x", 2, 3.0)], df.schema)
    assert tuple(D.read_quantiles(D.digests(full, ["value"], ["v"]), Q).first())[:4] == ("x", "v", 1, 3.0)
    with pytest.raises(ValueError):
        D.digests(df, [], ["v"], 0)
    with pytest.raises(ValueError):
        D.digests(df, ["column_name"], ["v"])
