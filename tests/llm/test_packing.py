import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quietfare.llm import packing as K
from quietfare.llm import queries


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=200), st.integers(1, 20), st.integers(1, 8))
def test_no_container_overflows(sizes, capacity, open_bins):
    p, used, seen = K.BestFit(capacity, open_bins), defaultdict(int), defaultdict(int)
    for i, s in enumerate(sizes):
        pieces = list(p.add(s))
        assert sum(x[3] for x in pieces) == s and (len(pieces) == 1) == (s <= capacity)
        for _, container, start, length in pieces:
            assert start == seen[i]
            seen[i] += length
            used[container] += length
        assert p.count <= open_bins
    assert all(u <= capacity for u in used.values())
    assert all(used[c] == u for c, u in p.still_open())


def test_best_fit_and_fullest_first():
    p = K.BestFit(10, 2)
    assert [p.place(s) for s in (6, 7, 3, 4, 5)] == [0, 1, 1, 0, 2]
    p = K.BestFit(10, 2)
    assert [p.place(s) for s in (6, 7, 8, 4)] == [0, 1, 2, 0]


def pack(spark, sizes, capacities, **more):
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, size bigint").repartition(3)
    return K.pack(df, capacities, size="size", text=None, **more)


def test_every_item_once_per_capacity(spark):
    random.seed(4)
    sizes = [random.choice([0, 1, 30, 90, 100, 101, 250]) for _ in range(600)] + [None, -5]
    rows = pack(spark, sizes, {1: 100, 2: 250}, open_bins=4).collect()
    for capacity_id, capacity in ((1, 100), (2, 250)):
        mine = [r for r in rows if r.capacity_id == capacity_id]
        total, used = defaultdict(int), defaultdict(int)
        for r in mine:
            total[r.doc_id] += r.size
            used[r.container_id] += r.size
        assert dict(total) == {i: max(0, s or 0) for i, s in enumerate(sizes)} and max(used.values()) <= capacity
        assert {r.doc_id for r in mine if r.piece > 0} == {i for i, s in enumerate(sizes) if s and s > capacity}
        assert sum(used.values()) / (len(used) * capacity) > 0.85


def test_texts_nulls_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, None), (3, "")], "doc_id bigint, text string")
    rows = K.pack(df, {5: 4}).orderBy("doc_id").collect()
    assert [(r.doc_id, r.size) for r in rows] == [(1, 3), (1, 3), (2, 0), (3, 0)]


def test_report_and_empty(spark):
    r = K.fill_report(pack(spark, [5, 5, 12], {1: 10}), {1: 10}).first()
    assert (r.containers, r.size, r.largest, r.cuts) == (3, 22, 10, 1)
    assert K.pack(spark.createDataFrame([], "doc_id bigint, text string"), {1: 10}).count() == 0
    with pytest.raises(ValueError):
        K.BestFit(0, 1)


def test_too_many_capacities_are_refused(spark, tmp_path):
    for n in (1000, 1001):
        spark.range(n).selectExpr("cast(id as int) as capacity_id", "'c' as label", "cast(id + 1 as int) as capacity_tokens").write.parquet(str(tmp_path / str(n) / "pack_capacities.parquet"))
    assert len(queries._capacities(spark, str(tmp_path / "1000"))) == 1000
    with pytest.raises(ValueError, match="more than 1000"):
        queries._capacities(spark, str(tmp_path / "1001"))
