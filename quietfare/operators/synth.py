"""Synthetic identities and labelled notes, deterministic in (seed, row key): every value is a hash of both, so no partitioning changes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietfare.functions.hashing import hash_sample
from quietfare.schemas import SPANS

GIVEN = ["Ada", "Bruno", "Carla", "Dario", "Edda", "Felix", "Gina", "Hugo", "Irma", "Jarek", "Kira", "Lothar"]
FAMILY = ["Abend", "Birke", "Conrad", "Dorn", "Eller", "Falk", "Gerke", "Hain", "Imhof", "Jansen", "Kolb", "Linde"]
PLACES = ["Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir"]


def uniform(key: Column, seed: int, purpose: str) -> Column:
    """A number in [0, 1) from the key, the seed and a purpose."""
    return F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(seed), F.lit(purpose)), 11) / F.lit(float(1 << 53))


def whole(key: Column, seed: int, purpose: str, low: int, high: int) -> Column:
    """A whole number in [low, high)."""
    return (F.floor(uniform(key, seed, purpose) * (high - low)) + low).cast("bigint")


def pick(key: Column, seed: int, purpose: str, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), whole(key, seed, purpose, 0, len(values)).cast("int"))


def zipf_rank(u: Column, n: int | Column, exponent: float) -> Column:
    """A rank in 1..n from a uniform number, by the inverse of the continuous Zipf distribution."""
    most = F.lit(n) if isinstance(n, int) else n
    top = F.pow((most + 1).cast("double"), F.lit(1 - exponent))
    return F.least(most, F.floor(F.pow(1 + u * (top - 1), F.lit(1 / (1 - exponent))))).cast("bigint")


def _letters(key: Column, seed: int, purpose: str, alphabet: str, n: int) -> Column:
    return F.concat(*[F.substring(F.lit(alphabet), whole(key, seed, f"{purpose}{i}", 1, len(alphabet) + 1).cast("int"), F.lit(1)) for i in range(n)])


def uuid4(key: Column, seed: int, purpose: str) -> Column:
    """A UUID of version 4 from the hash of key, seed and purpose."""
    x = F.sha2(F.concat_ws("|", F.lit(seed), F.lit(purpose), key.cast("string")), 256)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(x, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(x, 1, 8), F.substring(x, 9, 4), F.concat(F.lit("4"), F.substring(x, 14, 3)), F.concat(variant, F.substring(x, 18, 3)), F.substring(x, 21, 12))


def _full_name(who: Column, seed: int, purpose: str = "") -> Column:
    return F.concat_ws(" ", pick(who, seed, f"given{purpose}", GIVEN), pick(who, seed, f"family{purpose}", FAMILY))


def _vin(who: Column, seed: int, purpose: str = "vin") -> Column:
    return _letters(who, seed, purpose, "ABCDEFGHJKLMNPRSTUVWXYZ0123456789", 17)


def _plate(who: Column, seed: int, purpose: str = "plate", gap: str = "-") -> Column:
    return F.concat(_letters(who, seed, purpose, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3), F.lit(gap), whole(who, seed, purpose, 1000, 10_000).cast("string"))


def _phone(who: Column, seed: int, purpose: str = "", gap: str = "-") -> Column:
    return F.concat_ws(gap, whole(who, seed, f"area{purpose}", 200, 989).cast("string"), whole(who, seed, f"pre{purpose}", 200, 989).cast("string"), _four(who, seed, f"line{purpose}"))


def _four(who: Column, seed: int, purpose: str) -> Column:
    return F.lpad(whole(who, seed, purpose, 0, 10_000).cast("string"), 4, "0")


def identities(df: DataFrame, key: str, seed: int = 4242, riders: int | None = None, drivers: int | None = None) -> DataFrame:
    """``df`` with the identifiers of a skewed pool of riders and one of drivers. Columns of those names are replaced.

    The pools have a fifth and an eighth as many members as there are rows, one
    at least, unless told otherwise; the rows are counted in the same plan.
    """
    k = F.col(key)
    rows = df.agg(F.count(F.lit(1))).scalar()
    pool = lambda given, part: F.lit(given) if given else F.greatest(F.lit(1), F.floor(rows / part))
    rider, driver = zipf_rank(uniform(k, seed, "rider"), pool(riders, 5), 1.07), zipf_rank(uniform(k, seed, "driver"), pool(drivers, 8), 1.03)
    r, d = F.col("_r"), F.col("_d")
    return df.withColumn("_r", rider).withColumn("_d", driver).withColumns({
        "trip_id": uuid4(k, seed, "trip"), "rider_id": uuid4(r, seed, "rider"), "device_id": uuid4(r, seed, "device"), "rider_phone": _phone(r, seed),
        "payment_token": F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.lit("token"), r), 256), 1, 16),
        "rider_email": F.concat(F.lower(F.replace(_full_name(r, seed), F.lit(" "), F.lit("."))), r.cast("string"), F.lit("@example.org")),
        "driver_name": _full_name(d, seed), "driver_license_num": whole(d, seed, "license", 100_000, 10_000_000).cast("string"), "vehicle_plate": _plate(d, seed), "vehicle_vin": _vin(d, seed),
    }).drop("_r", "_d")


Part = str | tuple[str, str]  # text, or (entity type, name of a value)


def heldout_notes(df: DataFrame, key: str, seed: int = 2026, pii_share: float = 0.7) -> DataFrame:
    """Notes in formats that the note recognizers don't know, to measure what they miss: key, ``support_note``, ``gold``."""
    k = F.col(key)
    number = lambda p, low, high: whole(k, seed, p, low, high).cast("string")
    digits = F.concat(_four(k, seed, "p1"), _four(k, seed, "p2"))
    vin = _vin(k, seed)
    mail = F.lower(pick(k, seed, "mail", GIVEN))
    values = {
        "slashes": _phone(k, seed, gap="/"), "grouped": F.concat(number("g", 200, 989), F.lit(" "), F.substring(digits, 1, 2), F.lit(" "), F.substring(digits, 3, 2), F.lit(" "), F.substring(digits, 5, 3)),
        "numbered": F.concat(number("house", 1, 900), F.lit(" "), number("ave", 4, 99), F.lit("th Avenue")), "place": F.concat(pick(k, seed, "place", PLACES), F.lit(" Terminal")),
        "plus": F.concat(mail, F.lit("+trips@example.org")), "subdomain": F.concat(mail, F.lit("@mail.support.example.org")),
        "last four": _four(k, seed, "card"), "bullets": F.concat(F.lit("•••• "), _four(k, seed, "card")), "starred": F.concat(F.lit("**** **** **** "), _four(k, seed, "card")),
        "bare licence": whole(k, seed, "tlc", 1_000_000, 10_000_000).cast("string"), "spaced plate": _plate(k, seed, gap=" "),
        "spaced vin": F.concat_ws(" ", F.substring(vin, 1, 5), F.substring(vin, 6, 6), F.substring(vin, 12, 6)), "name": _full_name(k, seed, "h"),
    }
    templates: list[list[Part]] = [
        ["They left the number ", ("PHONE_NUMBER", "slashes"), " with ", ("PERSON", "name"), "."], ["Ring back on ", ("PHONE_NUMBER", "grouped"), " tonight."],
        ["Dropped at ", ("LOCATION", "numbered"), " by mistake."], ["Waited inside ", ("LOCATION", "place"), " for an hour."],
        ["Receipt goes to ", ("EMAIL_ADDRESS", "plus"), ", says ", ("PERSON", "name"), "."], ["Write to ", ("EMAIL_ADDRESS", "subdomain"), " instead."],
        ["The card whose last digits are ", ("CREDIT_CARD", "last four"), " was refused."], ["Charged to ", ("CREDIT_CARD", "bullets"), " again."], ["Billed on ", ("CREDIT_CARD", "starred"), " twice."],
        ["The chauffeur showed ", ("TLC_LICENSE", "bare licence"), " at the kerb."], ["The car, ", ("NY_PLATE", "spaced plate"), ", was double parked."], ["Inspection lists ", ("VEHICLE_VIN", "spaced vin"), "."],
    ]
    decoys = [F.concat(F.lit("Order "), number("o", 100, 999), F.lit(" was refunded.")), F.concat(F.lit("The wait was "), number("w", 2, 30), F.lit(" minutes, as agreed.")), F.lit("Driver was polite and on time.")]
    return _written(df.select(key), k, seed, values, templates, decoys, pii_share)


def dev_slice(df: DataFrame, key: str, order: list[str], n: int, seed: int = 4242) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): the ``n`` rows of a stable hash sample with synthetic identities and notes, and a row per gold span."""
    sample = identities(hash_sample(df, order, n, key), key, seed)
    written = notes(sample, key, seed)
    labels = written.select(key, F.col("support_note").alias("_t"), F.explode("gold").alias("s"))
    value = F.substring(F.col("_t"), F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    return sample.drop("support_note").join(written.select(key, "support_note"), key, "left"), labels.select(key, "s.entity_type", "s.start", "s.end", F.sha2(value, 256).alias("value_hash"))


def notes(df: DataFrame, key: str, seed: int = 4242, rate: float = 0.02, pii_share: float = 0.75) -> DataFrame:
    """Notes for a share of the rows: key, ``support_note`` and ``gold``, the spans of the personal values that were put in.

    Decoy notes have numbers but no personal value and an empty gold array.
    """
    k = F.col(key)
    chosen = df.where(uniform(k, seed, "note") < rate).select(key)
    values = {
        "phone": _phone(k, seed, "n"), "plate": _plate(k, seed, "np"), "vin": _vin(k, seed, "nv"), "name": _full_name(k, seed, "n"), "licence": whole(k, seed, "tlc", 1_000_000, 10_000_000).cast("string"),
        "card": F.concat(pick(k, seed, "mask", ["****", "xxxx-xxxx-xxxx-"]), _four(k, seed, "card")), "street": F.concat_ws(" ", whole(k, seed, "house", 1, 3000), pick(k, seed, "street", PLACES)),
        "mail": F.concat(F.lower(pick(k, seed, "mail", GIVEN)), whole(k, seed, "mailno", 1, 999).cast("string"), F.lit("@example.org")),
    }
    person, phone, mail, street = ("PERSON", "name"), ("PHONE_NUMBER", "phone"), ("EMAIL_ADDRESS", "mail"), ("LOCATION", "street")
    templates: list[list[Part]] = [
        ["Talked to ", person, ", calling from phone ", phone, ", about a bag."], ["The corrected receipt should reach ", mail, " this week."],
        ["Driver says ", person, " dropped a key near ", street, "."], ["Card ", ("CREDIT_CARD", "card"), " charged twice, according to ", person, "."],
        ["Move the pickup near ", street, "; call ", phone, " before."], [person, " (", mail, ", ", phone, ") disputes a bill."],
        ["TLC license ", ("TLC_LICENSE", "licence"), " is named in a complaint by ", person, "."], ["Car with plate ", ("NY_PLATE", "plate"), " blocked the lane near ", street, "."],
        ["VIN ", ("VEHICLE_VIN", "vin"), " stands in the claim of ", person, ", phone ", phone, "."],
    ]
    decoys = [
        F.concat(F.lit("Confirmation number "), whole(k, seed, "d1", 1_000_000, 10_000_000).cast("string"), F.lit(" issued.")), F.concat(F.lit("Fare of $"), whole(k, seed, "d2", 5, 99).cast("string"), F.lit(" checked and kept.")),
        F.concat(F.lit("Trip "), F.substring(F.sha2(k.cast("string"), 256), 1, 12), F.lit(" took a detour; closed.")), F.concat(F.lit("Waited "), whole(k, seed, "d3", 2, 20).cast("string"), F.lit(" minutes at the kerb.")),
    ]
    return _written(chosen, k, seed, values, templates, decoys, pii_share)


def stats(df: DataFrame, written: DataFrame, rider: str = "rider_id") -> DataFrame:
    """One row: rows and distinct riders of ``df``, notes, spans and decoys of ``written``."""
    people = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(rider).alias("riders"))
    made = written.agg(F.count(F.lit(1)).alias("notes"), F.coalesce(F.sum(F.size("gold")), F.lit(0)).alias("spans"), F.count_if(F.size("gold") == 0).alias("decoys"))
    one = F.lit(1).alias("_one")
    return people.select("*", one).join(made.select("*", one), "_one").drop("_one")


def _written(chosen: DataFrame, k: Column, seed: int, values: dict[str, Column], templates: list[list[Part]], decoys: list[Column], pii_share: float) -> DataFrame:
    """The chosen rows with a template's note and the spans of its values, or a decoy."""

    def note(parts: list[Part]) -> Column:
        at, texts, spans = F.lit(0), [], []
        for part in parts:
            text = F.lit(part) if isinstance(part, str) else F.col(f"_v.`{part[1]}`")
            end = at + F.length(text)
            if not isinstance(part, str):
                spans.append(F.struct(F.lit(part[0]).alias("entity_type"), at.alias("start"), end.alias("end"), F.lit(1.0).alias("score")))
            texts, at = [*texts, text], end
        return F.struct(F.concat(*texts).alias("support_note"), F.array(*spans).cast(SPANS).alias("gold"))

    # the values are columns of their own, so that no template repeats how they are made
    made = chosen.withColumns({"_v": F.struct(*[v.alias(name) for name, v in values.items()]), "_w": whole(k, seed, "template", 0, len(templates)).cast("int")})
    personal = F.lit(None)
    for i, parts in enumerate(templates):  # only the chosen one is worked out
        personal = F.when(F.col("_w") == i, note(parts)).otherwise(personal)
    decoy = F.struct(F.get(F.array(*decoys), whole(k, seed, "decoy", 0, len(decoys)).cast("int")).alias("support_note"), F.array().cast(SPANS).alias("gold"))
    return made.withColumn("_n", F.when(uniform(k, seed, "kind") < pii_share, personal).otherwise(decoy)).select(*chosen.columns, "_n.support_note", "_n.gold")
