import pytest

from quietfare.llm import personal as P


def values(text):
    return {(text[a:b], k) for a, b, k in P.find_spans(text)}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mail jane.doe+x@mail.example.org.", {("jane.doe+x@mail.example.org", "EMAIL_ADDRESS")}),
        ("write to jane at mail dot example dot org, please", {("jane at mail dot example dot org", "EMAIL_ADDRESS")}),
        ("(jane(at)post.example).", {("jane(at)post.example", "EMAIL_ADDRESS")}),
        ("jane [at] post [dot] example wrote", {("jane [at] post [dot] example", "EMAIL_ADDRESS")}),
        ("Look at this. We met at noon.", set()),
        ("call (212) 555-0123 ext. 45 now", {("(212) 555-0123 ext. 45", "PHONE_NUMBER")}),
        ("cb 212–555–0123; alt +44 7700 900123", {("212–555–0123", "PHONE_NUMBER"), ("+44 7700 900123", "PHONE_NUMBER")}),
        ("my number is ２１２５５５０１２３", {("２１２５５５０１２３", "PHONE_NUMBER")}),
        ("reach me: two one two five five five zero one two three.", {("two one two five five five zero one two three", "PHONE_NUMBER")}),
        ("order 7350845, auth 6319007, Meter id 324-20-258, ticket TKT-3226, v17.5.2", set()),
        ("card 4111 1111 1111 1111 declined", {("4111 1111 1111 1111", "CREDIT_CARD")}),
        ("card 4111 1111 1111 1112 declined", set()),
        ("refund to ****-****-****-9704", {("****-****-****-9704", "CREDIT_CARD")}),
        ("card •••• 2031 twice", {("•••• 2031", "CREDIT_CARD")}),
        ("SSN 959-31-3974 on file", {("959-31-3974", "ID_NUMBER")}),
        ("Passport QA526780657 found", {("QA526780657", "ID_NUMBER")}),
        ("TLC license 1671797 shown", {("1671797", "TLC_LICENSE")}),
        ("Medallion 6634015: rude", {("6634015", "TLC_LICENSE")}),
        ("plate cuz-1077 and tag T430554C", {("cuz-1077", "NY_PLATE"), ("T430554C", "NY_PLATE")}),
        ("VIN FD7-P4A00B-HHVZRVXB reads", {("FD7-P4A00B-HHVZRVXB", "VEHICLE_VIN")}),
        ("chassis 8UVRG PWWBNM N7XLE3 does", {("8UVRG PWWBNM N7XLE3", "VEHICLE_VIN")}),
        ("dropped at 1588 Tilver St, Apt. 17B.", {("1588 Tilver St, Apt. 17B", "LOCATION")}),
        ("Lives 1829 Dunmere", {("1829 Dunmere", "LOCATION")}),
        ("la dejó en Av. Marlock núm. 195 y no", {("Av. Marlock núm. 195", "LOCATION")}),
        ("Course annulée, 140 bis rue du Quarrow.", {("140 bis rue du Quarrow", "LOCATION")}),
        ("Car stood 11 min at the curb near Pilgrim Market", set()),
        ("2 Hill Street Market rides", set()),
        ("Neighbor (Linnea O'Brennick Jr., said)", {("Linnea O'Brennick Jr.", "PERSON")}),
        ("noted, al-Murrane, Ravi", {("al-Murrane, Ravi", "PERSON")}),
        ("Blocked by Viktor Sondowska's car", {("Viktor Sondowska", "PERSON")}),
        ("operator is M. Branorim", {("M. Branorim", "PERSON")}),
        ("only farida marleño was charged", {("farida marleño", "PERSON")}),
        ("May will rose grant summer chase 294: test note", set()),
        ("乘客柯临要求回电", {("柯临", "PERSON")}),
        ("Водитель не приехал, Савва Велькин", {("Савва Велькин", "PERSON")}),
    ],
)
def test_values(text, want):
    assert values(text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Bartholomew Quigley left a bag", {("Bartholomew Quigley", "PERSON")}),
        ("Spoke with Fiona Gallagher today", {("Fiona Gallagher", "PERSON")}),
        ("Saoirse Brennan complained", {("Saoirse Brennan", "PERSON")}),
        ("We refunded Dwayne Pettigrew.", {("Dwayne Pettigrew", "PERSON")}),
        ("Xiu Ling Chan called us", {("Xiu Ling Chan", "PERSON")}),
        ("Torvald P. Haugen, Jr. says so", {("Torvald P. Haugen, Jr.", "PERSON")}),
        ("Guinevere Locke <gl@post.example>", {("Guinevere Locke", "PERSON"), ("gl@post.example", "EMAIL_ADDRESS")}),
        ("Two riders, Oksana Bilyk and Zoltan Nagy, split it", {("Oksana Bilyk", "PERSON"), ("Zoltan Nagy", "PERSON")}),
        ("王小明说司机没来", {("王小明", "PERSON")}),
        ("승객 김민수 님이 기다렸다", {("김민수", "PERSON")}),
        ("Ο επιβάτης Γιώργος Παπαδόπουλος περίμενε", {("Γιώργος Παπαδόπουλος", "PERSON")}),
        ("Abholung Hauptstraße 12 bitte", {("Hauptstraße 12", "LOCATION")}),
        ("Fermata in Via Roma 12, grazie", {("Via Roma 12", "LOCATION")}),
        ("Odbiór: ul. Leśna 5/7 dzisiaj", {("ul. Leśna 5/7", "LOCATION")}),
        ("Send it to P.O. Box 4411 please", {("P.O. Box 4411", "LOCATION")}),
        ("Meet at 12 Rue", set()),
        ("Tallow Crossing was closed. Linden Yards Garage reports 393 vehicles. State ID was used. Lost Property called.", set()),
        ("The owner seems to be very upset. Night desk says no.", set()),
    ],
)
def test_values_beyond_the_lists(text, want):
    assert values(text) == want


def test_values_longer_than_any_window():
    long = "x" * 300
    for value, kind in [(f"{long}@mail.example", "EMAIL_ADDRESS"), (f"a@{'b.' * 200}example", "EMAIL_ADDRESS"), (f"Anna {'Berg-' * 60}Holm", "PERSON"), (f"12 {'A' + 'b' * 200} Street", "LOCATION")]:
        text = f"mail {value} please"
        assert values(text) == {(value, kind)} and P.redact(text, P.find_spans(text)) == f"mail [{kind}] please"
    filler = "number on file is: " * 20
    assert values(f"SSN {filler}959-31-3974.") == {("959-31-3974", "ID_NUMBER")}
    assert values(f"VIN {'of the car as the inspector read it twice ' * 3}FD7-P4A00B-HHVZRVXB.") == {("FD7-P4A00B-HHVZRVXB", "VEHICLE_VIN")}


UNLISTED = ["Bartholomew", "Fiona", "Saoirse", "Dwayne", "Torvald", "Guinevere", "Zoltan", "Perpetua", "Cassius", "Ulrike", "Baldwin", "Oksana", "Thandiwe", "Ludmila", "Ferdinand", "Quentin", "Rosalind", "Nkechi", "Anneliese"]


def test_recall_with_every_given_name_unlisted(spark):
    """The notes of a small table, with each listed given name replaced by one that no list holds."""
    import random
    import re

    assert not {n.lower() for n in UNLISTED} & (set(P.GIVEN_NAMES) | set(P.WORD_NAMES))
    random.seed(7)
    notes = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/trips.parquet").where("support_note <> ''").select("support_note").distinct().collect()]
    want = hit = 0

    def renamed(m):
        name = random.choice(UNLISTED)
        return m.group() if m.group().lower() not in P._GIVEN else name.lower() if m.group().islower() else name.upper() if m.group().isupper() else name

    for note in notes:
        out, gold, at = "", set(), 0
        for start, end, kind in P.find_spans(note):
            value = re.sub(r"[^\W\d_]+", renamed, note[start:end]) if kind == "PERSON" else note[start:end]
            out += note[at:start]
            if value != note[start:end]:
                gold.add((len(out), len(out) + len(value)))
            out, at = out + value, end
        found = {(a, b) for a, b, kind in P.find_spans(out + note[at:]) if kind == "PERSON"}
        want, hit = want + len(gold), hit + len(gold & found)
    assert want > 300 and hit / want >= 0.9


@pytest.mark.parametrize("text", [None, "", "   ", "\n", "🙏"])
def test_nothing_to_find(text):
    assert P.find_spans(text) == []


def test_redact_changes_only_the_values():
    text = "Ａ note: call (212) 555-0123, plate ABC-1234 🙏"
    assert P.redact(text, P.find_spans(text)) == "Ａ note: call [PHONE_NUMBER], plate [NY_PLATE] 🙏"
    assert P.redact(None, []) is None


def test_spans_are_in_order_and_apart():
    text = "Dr. Anna Berg, anna@x.example, 212-555-0123, plate ABC-1234. " * 50
    spans = P.find_spans(text)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)) and len(spans) == 200


@pytest.mark.parametrize("unit", ["a@b.example ", "Anna Berg ", "212-555-0123 ", "A. ", "one two ", "@", "((", "****", " at ", "1", "Anna-", "id ", "vin ", "is Anna ", "Max Berg, ", "a1", "said ", "12 via "])
def test_very_long_texts_end(unit):
    P.find_spans(unit * 20000)


def test_on_a_table(spark):
    rows = [(1, "x", "mail a@b.example"), (1, "x", "mail a@b.example"), (2, "y", None), (3, None, ""), (4, "z", "nothing")]
    df = spark.createDataFrame(rows, "id int, entity_type string, note string")
    got = P.personal_spans(df, "note", ("id",)).collect()
    assert sorted(map(tuple, got)) == [(1, 5, 16, "EMAIL_ADDRESS")] * 2
    assert [r.redacted for r in P.redact_column(df, "note").orderBy("id").collect()] == ["mail [EMAIL_ADDRESS]"] * 2 + [None, "", "nothing"]
    assert P.personal_spans(df.limit(0), "note", ("id",)).count() == 0


def test_an_export_may_redact_names_too(spark):
    from quietfare.plans import export as E
    from quietfare.plans.policy import Policy

    df = spark.createDataFrame([(1, "Saoirse Brennan complained, mail a@b.example"), (2, None), (3, "nothing")], "id int, support_note string")
    policy = Policy("toy", 1, "", "row_level", row_level={"redact_note": True})
    got = [r.support_note for r in E.export(df, policy, detector=P.note_detector).orderBy("id").collect()]
    assert got == ["[REDACTED] complained, mail [REDACTED]", None, "nothing"]
