from quietfare.operators import kanon

ROWS = [(1, 10), (1, 10), (2, 20), (2, 20), (3, 30)]


def test_uniqueness_and_suppression(spark):
    df = spark.createDataFrame(ROWS, "a int, b int")
    r = kanon.risk(df, ["a", "b"], 2).first()
    assert (r.uniqueness, r.rows_in, r.rows_out, r.cells_suppressed, r.k_achieved) == (0.2, 5, 4, 1, 2)
    assert sorted(map(tuple, kanon.suppress(df, ["a", "b"], 2).collect())) == sorted(ROWS[:4])


def test_all_singletons_and_empty(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "a int, b int")
    assert kanon.suppress(df, ["a", "b"], 2).count() == 0 and kanon.risk(df, ["a", "b"], 2).first().k_achieved is None
    r = kanon.risk(df.limit(0), ["a", "b"], 2).first()
    assert (r.uniqueness, r.suppressed, r.rows_in, r.k_achieved) == (0.0, 0.0, 0, None)


def test_null_keys_form_a_class(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None)], "a int, b int")
    assert kanon.suppress(df, ["a", "b"], 2).count() == 2 and kanon.classes(df, ["a", "b"]).count() == 2


def test_class_sizes_with_nulls_and_a_clashing_name(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 9)], "a int, class_size int")
    assert sorted(map(tuple, kanon.class_size(df, ["a"]).collect()), key=str) == [(1, 1), (None, 2), (None, 2)]


def test_ladder_equals_the_rungs(spark):
    df = spark.createDataFrame([(i % 3, i % 5 if i % 4 else None, i % 7) for i in range(60)], "a int, b int, c int")
    rungs = {"ab": ["a", "b"], "abc": ["a", "b", "c"], "c": ["c"]}
    got = {r.qi: tuple(r)[1:] for r in kanon.ladder(df, rungs).collect()}
    assert got == {label: tuple(kanon.risk(df, qi).first()) for label, qi in rungs.items()}


def test_cells(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 4, "a int")
    assert [tuple(r) for r in kanon.cells(df, ["a"], 5).collect()] == [(1, 5)]
    assert tuple(kanon.cells_audit(df, ["a"], 5).first()) == (2, 1, 1, 5, 9, 5)
