import re

import pytest
from pyspark.sql import functions as F

from quietfare.functions import spans as P
from quietfare.operators import evaluate as EV

S = "array<struct<entity_type:string,start:int,end:int,score:double>>"


def types(spark, text):
    return {s.entity_type for s in spark.createDataFrame([(text,)], "t string").select(P.scan(F.col("t"))).first()[0]}


@pytest.mark.parametrize(
    ("text", "want", "never"),
    [
        ("Complaint filed against TLC license 1234567; driver John Smith contacted.", {"TLC_LICENSE"}, set()),
        ("Confirmation number 4839271 issued for the rebooked ride.", set(), {"TLC_LICENSE"}),
        ("Reported plate ABC-1234 for an incident near 842 Sandra.", {"NY_PLATE", "LOCATION"}, set()),
        ("Check VIN 1HGCM82633A004352; rider Jane Doe at 212.555.1234.", {"VEHICLE_VIN", "PHONE_NUMBER"}, set()),
        ("Dispute: card ending ****1234 twice.", {"CREDIT_CARD"}, set()),
        ("(443) 297-8143", {"PHONE_NUMBER"}, set()), ("738 703 4191", {"PHONE_NUMBER"}, set()), ("2125551234", {"PHONE_NUMBER"}, set()), ("570.975.3835", {"PHONE_NUMBER"}, set()),
        ("212/555/1234", set(), {"PHONE_NUMBER"}), ("•••• 1234", set(), {"CREDIT_CARD"}), ("200 5th Avenue", set(), {"LOCATION"}),
    ],
)
def test_recognizers(spark, text, want, never):
    got = types(spark, text)
    assert want <= got and not never & got


def test_offsets_equal_re(spark):
    texts = ["", "a@b.cd", "x a@b.cd, c@d.ef!", "no", None, "ü a@b.cd é"]
    r = next(x for x in P.RECOGNIZERS if x.entity_type == "EMAIL_ADDRESS")
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.matches(F.col("t"), r).alias("m")).collect()
    for row in got:
        assert [(s.start, s.end) for s in row.m] == [m.span() for m in re.finditer(r.pattern, row.t or "")]


def test_deconflict_and_redact(spark):
    spans = [("A", 0, 5, 0.5), ("B", 3, 9, 0.9), ("C", 20, 22, 0.5), ("D", 20, 25, 0.5)]
    df = spark.createDataFrame([("Call John Doe at 212.555.1234 now", [("P", 5, 13, 1.0), ("Q", 17, 29, 1.0)], spans), (None, [], []), ("abc", [], [])], f"t string, s {S}, o {S}")
    got = df.select(P.redact(F.col("t"), F.col("s"), "X"), P.deconflict(F.col("o"))).collect()
    assert [r[0] for r in got] == ["Call X at X now", None, "abc"] and [s.entity_type for s in got[0][1]] == ["B", "D"]


CASES = [
    ([("PERSON", 0, 5)], [("PERSON", 2, 8)], (1, 0, 0)), ([("LOCATION", 0, 5)], [("PERSON", 0, 5)], (0, 1, 1)), ([("PERSON", 0, 4)], [("PERSON", 10, 14)], (0, 1, 1)),
    ([("TLC_LICENSE", 0, 7)], [], (0, 1, 0)), ([], [("PHONE", 0, 9)], (0, 0, 1)), ([("PERSON", 0, 20)], [("PERSON", 0, 5), ("PERSON", 8, 12)], (1, 0, 1)), ([], [], (0, 0, 0)),
]


@pytest.mark.parametrize(("found", "gold", "want"), CASES)
def test_greedy_matching(spark, found, gold, want):
    df = spark.createDataFrame([([(*s, 1.0) for s in found], [(*s, 1.0) for s in gold])], f"found {S}, gold {S}")
    rows = EV.outcomes(df).collect()
    assert (sum(r.tp for r in rows), sum(r.fp for r in rows), sum(r.fn for r in rows)) == want


def test_scores(spark):
    df = spark.createDataFrame([([(*s, 1.0) for s in f], [(*s, 1.0) for s in g]) for f, g, _ in (CASES[0], CASES[3], CASES[4])] + [([], [("PERSON", 1, 2, 1.0)])], f"found {S}, gold {S}")
    got = {r.entity: r for r in EV.scores(EV.outcomes(df)).collect()}
    assert (got["overall"].tp, got["overall"].fp, got["overall"].fn) == (1, 1, 2) and got["PERSON"].recall == 0.5 and got["TLC_LICENSE"].precision == 0.0


def test_align(spark):
    notes = spark.createDataFrame([(1, "x"), (2, "y")], "id int, note string")
    labels = spark.createDataFrame([(1, "P", 5, 6), (1, "P", 1, 2)], "id int, entity_type string, start int, end int")
    got = {r.id: [s.start for s in r.gold] for r in EV.align(notes, labels, "id").collect()}
    assert got == {1: [1, 5], 2: []}


def test_whole_cards_pass_the_checksum(spark):
    texts = ["card 4111 1111 1111 1111 declined", "card 4111 1111 1111 1112 declined", "id 411111111111111", None, "4111-1111-1111-1111, 5500005555555559."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [(s.entity_type, r.t[s.start : s.end]) for s in r.f if s.entity_type == "CREDIT_CARD"] for r in df.select("i", "t", P.scan(F.col("t")).alias("f")).collect()}
    assert got == {0: [("CREDIT_CARD", "4111 1111 1111 1111")], 1: [], 2: [], 3: [], 4: [("CREDIT_CARD", "4111-1111-1111-1111"), ("CREDIT_CARD", "5500005555555559")]}


def test_redact_builds_the_text_once(spark):
    text = "mail a@b.org and c@d.org, " * 300
    out = spark.createDataFrame([(text,), ("",), (None,), ("nothing",)], "t string").select(P.redact(F.col("t"), P.scan(F.col("t"))).alias("r")).collect()
    assert [r.r for r in out] == ["mail [REDACTED] and [REDACTED], " * 300, "", None, "nothing"]


def test_rescan_counts_what_it_masks(spark):
    df = spark.createDataFrame([("mail a@b.org or 212-555-0123",), ("nothing",), ("",), (None,)], "t string")
    got = [r.x and tuple(r.x) for r in df.select(P.rescan(F.col("t")).alias("x")).collect()]
    assert got == [("mail [REDACTED] or [REDACTED]", 2), ("nothing", 0), ("", 0), None]
