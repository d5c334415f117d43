import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quietfare.llm import mixing as M

TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("absent", 0.1, 2)]


def items(spark, n=900):
    random.seed(6)
    rows = [(i, random.choice("aaaaaabbc"), random.randint(0, 40)) for i in range(n)] + [(9001, None, 5), (9002, "other", 5), (9003, "a", None)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")


def mix(spark, df, targets=TARGETS, budget=None):
    return M.mix(df, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), "size", M.hash_place(F.col("doc_id")), budget=budget)


def test_shares_and_caps(spark):
    df = items(spark)
    chosen, shares = mix(spark, df)
    got = {r.source: r for r in shares.collect()}
    scale = 0.5 + 0.3 + 0.2
    for s, w, r in TARGETS[:3]:
        assert abs(got[s].actual_share - w / scale) < 0.03 and got[s].most_repeats <= r
    assert got["absent"].chosen_size == 0 and got["absent"].actual_share == 0.0
    rows = chosen.collect()
    assert {r.source for r in rows} == {"a", "b", "c"} and len({r.doc_id for r in rows}) == len(rows)
    assert any(got[s].chosen_size >= r * got[s].available_size - 40 for s, _, r in TARGETS[:3])


def test_thresholds_are_nested(spark):
    df = items(spark)
    small, large = ({r.doc_id: r.repeats for r in mix(spark, df, budget=b)[0].collect()} for b in (3000, 6000))
    assert all(large.get(i, 0) >= n for i, n in small.items()) and sum(large.values()) > sum(small.values())


def test_threshold_equals_the_sorted_prefix(spark):
    df = items(spark).where("size > 0").withColumn("place", M.hash_place(F.col("doc_id"))).cache()
    rows = sorted((r.place, r.size) for r in df.where("source = 'b'").collect())
    budget = Fraction(sum(s for _, s in rows) // 3)
    last = M._thresholds(df.select("source", "size", "place"), {"b": budget})["b"]
    taken = sum(s for p, s in rows if p <= last)
    nxt = next(s for p, s in rows if p > last)
    assert abs(taken - budget) <= abs(taken + nxt - budget)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.sampled_from("abcd"), st.integers(1, 10**9), min_size=1), st.lists(st.tuples(st.integers(1, 99), st.integers(0, 5)), min_size=4, max_size=4))
def test_plan_obeys_caps_and_shares(totals, rules):
    targets = {s: (Fraction(w, 100), r) for s, (w, r) in zip("abcd", rules, strict=True)}
    plan = M.plan(totals, targets)
    assert all(x <= targets[s][1] * totals[s] for s, x in plan.items())
    ratios = {x / targets[s][0] for s, x in plan.items()}
    assert len(ratios) <= 1


def test_empty_and_wrong_targets(spark):
    chosen, shares = mix(spark, items(spark).limit(0))
    assert chosen.count() == 0 and [r.actual_share for r in shares.collect()] == [0.0] * 4
    with pytest.raises(ValueError):
        mix(spark, items(spark), [("a", 0.5, 1), ("a", 0.5, 1)])


def test_clashing_columns(spark):
    df = items(spark).withColumn("place", F.lit("x")).withColumn("repeats", F.lit(7)).withColumn("budget", F.lit(1))
    assert {r.doc_id for r in mix(spark, df)[0].collect()} == {r.doc_id for r in mix(spark, items(spark))[0].collect()}
