import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quietfare.operators import skew


def test_heavy_keys_count_nulls_in_the_total(spark):
    rows = [(1,)] * 30 + [(2,)] * 3 + [(3,)] * 2 + [(None,)] * 65
    got = skew.heavy_keys(spark.createDataFrame(rows, "a int"), ["a"], spark.createDataFrame([(1,), (1,), (None,)], "id int")).select("field", "key", "rows", "total").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 30, 100), ("a", 2, 3, 100)]


def test_heavy_keys_of_an_empty_table(spark):
    assert skew.heavy_keys(spark.createDataFrame([], "a int, b int"), ["a", "b"], spark.createDataFrame([], "id int")).count() == 0


def test_eager_join_equals_the_join(spark):
    random.seed(1)
    left = [(random.choice([1, 1, 1, 2, 3, None]), random.choice("xy"), float(random.randint(0, 9))) for _ in range(200)]
    right = [(random.choice([1, 1, 2, 4, None]), random.choice("pq"), float(random.randint(0, 9))) for _ in range(80)]
    a, b = spark.createDataFrame(left, "k int, g string, v double"), spark.createDataFrame(right, "k int, h string, w double")
    eager = skew.eager_join_aggregate(a, b, ["k"], ["v"], ["w"], ["g"], ["h"])
    plain = a.join(b, "k").groupBy("k", "g", "h").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("sum_v"), F.sum("w").alias("sum_w"))
    assert sorted(map(tuple, eager.collect())) == sorted(map(tuple, plain.collect()))


def test_eager_left_join_keeps_unmatched_keys(spark):
    a, b = spark.createDataFrame([(1,), (1,), (9,)], "k int"), spark.createDataFrame([(1, "x")], "k int, h string")
    got = skew.eager_join_aggregate(a, b, ["k"], right_by=["h"], how="left").collect()
    assert sorted(map(tuple, got), key=str) == [(1, "x", 2), (9, None, 1)]


def test_eager_join_refuses_clashing_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    with pytest.raises(ValueError):
        skew.eager_join_aggregate(df, df, ["k"], ["v"], ["v"])


def test_sums_leave_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(1, 2.0), (1, float("nan")), (1, float("inf")), (1, None), (2, None)], "k int, v double")
    assert sorted(map(tuple, skew.key_states(df, ["k"], ["v"]).collect())) == [(1, 4, 2.0), (2, 1, 0.0)]


def test_states_merge_by_addition(spark):
    df = spark.createDataFrame([(i % 3, float(i)) for i in range(50)], "k int, v double")
    halves = skew.key_states(df.where("v < 20"), ["k"], ["v"]).union(skew.key_states(df.where("v >= 20"), ["k"], ["v"]))
    assert sorted(map(tuple, skew.merge_key_states(halves, ["k"]).collect())) == sorted(map(tuple, skew.key_states(df, ["k"], ["v"]).collect()))


def test_ranks_with_a_hot_key_nulls_and_ties(spark):
    random.seed(2)
    rows = [(random.choice([7, 7, 7, 7, 8, None]), random.choice([1, 2, None]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    got = {r.id: r.rank for r in skew.rank_in_key(df, ["k"], ["t", "id"], ["id"], "rank", 7).collect()}
    want, seen = {}, Counter()
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2])):
        seen[k] += 1
        want[i] = seen[k]
    assert got == want


def test_ranks_of_repeated_rows_are_all_given(spark):
    df = spark.createDataFrame([(1, 5)] * 4, "k int, t int")
    assert sorted(r.rank_in_key for r in skew.rank_in_key(df, ["k"], ["t"]).collect()) == [1, 2, 3, 4]
    assert skew.rank_in_key(df.limit(0), ["k"], ["t"]).count() == 0
